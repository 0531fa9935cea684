"""State snapshots: landed JSON documents ``{"time": ..., "states": [[...], ...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.functions import payload


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed snapshot file, whole text in ``value``."""
    return spark.read.text(path, wholetext=True)


def stream_snapshots(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .option("wholetext", True)
        .text(path)
    )


def explode_states(snapshots: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """One row per state: ``api_time``, ``position`` in the snapshot and the raw ``state``.

    A missing or null list of states yields no rows. A payload that is not a JSON object
    fails the job when ``strict``; otherwise such payloads are left out here and can be
    counted with :func:`malformed_snapshots`.
    """
    parsed = payload.with_document(snapshots.select(F.col(value).alias("_value")), F.col("_value"))
    if strict:
        problem = F.raise_error(F.lit("snapshot payload is not a JSON object"))
        parsed = parsed.select(F.coalesce("_doc", problem.cast("variant")).alias("_doc"))
    return parsed.select(
        payload.member(F.col("_doc"), "time", "bigint").alias("api_time"),
        F.posexplode(payload.member(F.col("_doc"), "states", "array<variant>")).alias(
            "position", "state"
        ),
    )


def malformed_snapshots(snapshots: DataFrame, value: str = "value") -> DataFrame:
    """The payloads that are not one JSON object."""
    return payload.with_document(snapshots, F.col(value)).where(F.col("_doc").isNull()).drop("_doc")


def element(index: int, kind: str = "variant") -> Column:
    """Element of the positional ``state`` array, null when absent or of another type."""
    return F.try_variant_get(F.col("state"), f"$[{index}]", kind)
