"""Stored rows in the order of their cells, for reads by area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from airlane.operators import area


def write_by_cell(rows: DataFrame, path: str, mode: str = "append", row_group_bytes: int = 32 << 20) -> None:
    """Write rows with their cell, in ranges of cells, each file sorted by it.

    Address and time break ties, so one place that holds a large part of all rows is split over
    files as well. Rows without a position are kept, before all others. A column of the cell's
    name is replaced.
    """
    order = [area.CELL, *[c for c in ("icao24", "observed_at") if c in rows.columns]]
    (
        rows.withColumn(area.CELL, area.cell())
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode(mode).option("parquet.block.size", row_group_bytes).parquet(path)
    )


def read_by_cell(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of `write_by_cell` with their cell column; filter them with `operators.area.in_box`."""
    fields = [f for f in schema.fields if f.name != area.CELL]
    return spark.read.schema(StructType([*fields, StructField(area.CELL, LongType())])).parquet(path)


def read_box(spark: SparkSession, path: str, schema: StructType, box: area.Box) -> DataFrame:
    """Rows inside a box, with the columns of ``schema``; row groups outside its cell ranges are skipped."""
    return area.in_box(read_by_cell(spark, path, schema), box).select(*[F.col(n) for n in schema.names])
