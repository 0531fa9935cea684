"""A stored copy of the message log in segments, so that retention frees whole files.

Every append writes segment files, each a run of offsets of one log partition, and then a row per
file: offset range, rows, bytes, newest time. Retention reads those rows only. It moves the first
kept offset of a partition, which readers obey at once; files wholly below it are deleted by
`free`, later, so that open readers finish. A log partition loses rows at its old end only.
"""

from __future__ import annotations

import json
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlane.functions import times
from airlane.operators.sequence import OFFSETS_PER_CHUNK, offset_chunk
from airlane.schemas import MESSAGE_SCHEMA, RAW_LOG_RETENTION_BYTES, RAW_LOG_RETENTION_HOURS
from airlane.sources import storage

PLACE = ["topic", "partition"]
#: Stored rows: the log's columns, the size that counts against the budget, and the directories.
LOG_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("_size", T.LongType()),
                           T.StructField("append", T.LongType()), T.StructField("chunk", T.LongType())])
#: A segment file of an append, by its name below the append's directory.
SEGMENT_SCHEMA = "topic STRING, partition INT, file STRING, first LONG, last LONG, rows LONG, bytes LONG, newest TIMESTAMP, append LONG"


def record_size() -> Column:
    """Bytes of key and value; headers count by their text."""
    part = lambda name: F.coalesce(F.octet_length(name), F.lit(0))
    return (part("key") + part("value") + F.coalesce(F.octet_length(F.to_json("headers")), F.lit(0))).cast("bigint")


def append(messages: DataFrame, path: str, number: int, size: Column | None = None,
           offsets: int = OFFSETS_PER_CHUNK) -> None:
    """Store a closed set of messages as append ``number``; repeating it replaces it.

    A file holds at most ``offsets`` offsets of one log partition. The rows that describe the files
    commit the append; they are computed from the files' narrow columns.
    """
    spark, where = messages.sparkSession, f"{path}/append={number}"
    sized = messages.select(*MESSAGE_SCHEMA.names, (record_size() if size is None else size).cast("bigint").alias("_size"))
    (
        sized.withColumn("chunk", offset_chunk(F.col("offset"), offsets))
        .hint("rebalance", *PLACE, "chunk").sortWithinPartitions(*PLACE, "chunk", "offset")
        .write.mode("overwrite").partitionBy(*PLACE, "chunk").parquet(where)
    )
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(where)
    file = F.element_at(F.split(F.col("_metadata.file_path"), f"/append={number}/"), -1)
    rows.groupBy(*PLACE, file.alias("file")).agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("rows"),
        F.sum("_size").alias("bytes"), F.max("timestamp").alias("newest"),
    ).write.mode("overwrite").parquet(f"{path}/_segments/append={number}")


def appends(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed appends."""
    found = [n for n in storage.names(spark, f"{path}/_segments") if storage.exists(spark, f"{path}/_segments/{n}/_SUCCESS")]
    return sorted(int(n.removeprefix("append=")) for n in found)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """A row per stored file, also of files below the start that are not deleted yet."""
    where = [f"{path}/_segments/append={n}" for n in appends(spark, path)]
    if not where:
        return spark.createDataFrame([], SEGMENT_SCHEMA)
    return spark.read.schema(SEGMENT_SCHEMA).option("basePath", f"{path}/_segments").parquet(*where)


def starts(spark: SparkSession, path: str) -> dict[tuple[str, int], int]:
    """First kept offset of every log partition that has lost rows."""
    number = _newest_start(spark, path)
    if number is None:
        return {}
    told = spark.read.option("wholetext", True).text(f"{path}/_starts/{number}.json").first()["value"]
    return {(topic, partition): start for topic, partition, start in json.loads(told)}


def _newest_start(spark: SparkSession, path: str) -> int | None:
    found = [int(n.removesuffix(".json")) for n in storage.names(spark, f"{path}/_starts") if n.endswith(".json") and n[0] != "."]
    return max(found, default=None)


def _start(known: dict[tuple[str, int], int]) -> Column:
    """The start of a row's log partition, from a map of one entry per log partition."""
    if not known:
        return F.lit(0).cast("bigint")
    entries = [x for (topic, partition), start in known.items()
               for x in (F.struct(F.lit(topic).alias("topic"), F.lit(partition).alias("partition")), F.lit(start).cast("bigint"))]
    return F.coalesce(F.try_element_at(F.create_map(*entries), F.struct(*PLACE)), F.lit(0).cast("bigint"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The kept messages of the committed appends."""
    where = [f"{path}/append={n}" for n in appends(spark, path) if storage.exists(spark, f"{path}/append={n}")]
    if not where:
        return spark.createDataFrame([], MESSAGE_SCHEMA)
    rows = spark.read.schema(LOG_SCHEMA).option("basePath", path).parquet(*where)
    return rows.where(F.col("offset") >= _start(starts(spark, path))).select(*MESSAGE_SCHEMA.names)


def retain(spark: SparkSession, path: str, as_of: datetime, max_bytes: int = RAW_LOG_RETENTION_BYTES,
           retention_hours: int = RAW_LOG_RETENTION_HOURS) -> dict[tuple[str, int], int]:
    """Move the starts past segments that age or size lets go, whichever is first; returns all starts.

    Per log partition, segments are kept from the newest back as long as those newer than them hold
    less than ``max_bytes``: the newest ``max_bytes`` stay, and at most one segment more than
    `retention.retain_by_size` keeps. A segment is old when its newest row is. A start never goes back.
    """
    known = starts(spark, path)
    newer = Window.partitionBy(*PLACE).orderBy(F.desc("first"), F.desc("append"), F.desc("file")).rowsBetween(
        Window.unboundedPreceding, -1)
    fits = F.coalesce(F.sum("bytes").over(newer), F.lit(0)) < max_bytes
    young = times.instant_to_utc(F.col("newest")) >= times.as_of_column(as_of) - times.hours(retention_hours)
    told = segments(spark, path).where(F.col("last") >= _start(known)).select(*PLACE, "first", "last", fits.alias("fits"), young.alias("young"))
    least = lambda kept: F.coalesce(F.min(F.when(kept, F.col("first"))), F.max("last") + 1)
    moved = told.groupBy(*PLACE).agg(F.greatest(least(F.col("fits")), least(F.col("young"))).alias("start"))
    now = {**known}
    for topic, partition, start in moved.collect():  # a row per log partition
        now[topic, partition] = max(start, known.get((topic, partition), 0))
    if now != known:
        number = _newest_start(spark, path)
        told = json.dumps([[topic, partition, start] for (topic, partition), start in sorted(now.items())])
        storage.create(spark, f"{path}/_starts/{0 if number is None else number + 1}.json", told)
    return now


def free(spark: SparkSession, path: str) -> int:
    """Delete the files wholly below the starts and the appends that have none left; returns bytes freed.

    Run it when readers opened before the last `retain` are done. What is brought to the driver is
    a row per file deleted.
    """
    below = F.col("last") < _start(starts(spark, path))
    told = segments(spark, path)
    freed = 0
    for number, file in told.where(below).select("append", "file").collect():
        where = f"{path}/append={number}/{unquote(file)}"
        freed += storage.size(spark, where)
        storage.delete(spark, where)
    empty = told.groupBy("append").agg(F.bool_and(below).alias("gone")).where("gone").select("append").collect()
    for (number,) in empty:
        storage.delete(spark, f"{path}/_segments/append={number}")
        storage.delete(spark, f"{path}/append={number}")
    current = _newest_start(spark, path)
    for name in storage.names(spark, f"{path}/_starts"):
        if name.endswith(".json") and name != f"{current}.json":
            storage.delete(spark, f"{path}/_starts/{name}")
    return freed
