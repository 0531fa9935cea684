"""Helpers the operators share: scratch tables, shared files, Arrow passes over whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.sources import tables

#: Rows per Arrow batch of a pass over texts; Spark also cuts batches by bytes.
ROWS_PER_BATCH = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small, so that a task holds a few long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``, see `tables.shared_folder`."""
    return f"{tables.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(frame: DataFrame, **keys) -> DataFrame:
    """The frame's rows as one struct ``row`` beside key columns, whose names then meet no column of the caller."""
    return frame.select(F.struct("*").alias("row"), *[column.alias(name) for name, column in keys.items()])


def text_hash(column: str = "text"):
    """Tells rows under one id apart; null and empty differ."""
    return F.xxhash64(F.col(column).isNull(), F.col(column))


def texts_of(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, null as empty, without decoding."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def with_columns(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array], carry: bool = True) -> pa.RecordBatch:
    """The batch with result columns put last; they replace columns of the same name. ``carry``: keep the text."""
    kept = [n for n in batch.schema.names if n not in names and (carry or n != "text")]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + arrays, names=kept + names)


def schema_with(frame: DataFrame, extra: str, carry: bool = True) -> str:
    """DDL of the frame's columns followed by ``extra`` (``name type, ...``), as `with_columns` lays them."""
    names = {part.strip().split(" ")[0] for part in extra.split(",")}
    kept = [f"`{n}` {t}" for n, t in frame.dtypes if n not in names and (carry or n != "text")]
    return ", ".join([*kept, extra])
