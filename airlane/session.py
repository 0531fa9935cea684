"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Runtime SQL settings that change results, not only speed.
REQUIRED_CONF = {
    # Log timestamps are rendered as UTC; event times are TIMESTAMP_NTZ in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as in common JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Settings that only change speed.
TUNING_CONF = {
    # HotSpot does not compile methods above 8,000 bytecodes; wide validation stages run
    # faster as separately generated projections than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The ids remembered for deduplication outgrow the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session, where they differ, and return it."""
    for key, value in {**REQUIRED_CONF, **TUNING_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
