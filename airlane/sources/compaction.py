"""Rewriting closed dates of history into few sorted files.

Every micro-batch adds its own files to a date, so the aircraft ranges of their row groups overlap.
A rewritten date is cut into ranges of aircraft and time: a reader of one aircraft opens the row
groups that may hold it. The switch is one manifest per date, see `manifest`; what it replaced is
deleted later by `drop_replaced`, so that open readers finish. Appends may go on meanwhile; one
compaction or deletion of a history runs at a time.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from airlane.schemas import HISTORY_SCHEMA
from airlane.sources import manifest, storage, tables

#: Size of a rewritten file.
FILE_BYTES = 256 << 20


def compact_closed(spark: SparkSession, path: str, before: date, least_files: int = 2,
                   file_bytes: int = FILE_BYTES) -> list[str]:
    """Rewrite the dates before ``before`` that have at least so many files to fold, a job each.

    A date counts when ``least_files`` files stand in it and any of them is not a rewritten one; late
    rows thus bring a date up again. Rows without an ingestion time belong to no date and stay as
    they are. Returns the dates rewritten.
    """
    done = []
    for day in tables.dates(spark, path):
        if day is not None and day < before and compact_date(spark, path, day, least_files, file_bytes):
            done.append(day.isoformat())
    return done


def compact_date(spark: SparkSession, path: str, day: date, least_files: int = 2,
                 file_bytes: int = FILE_BYTES) -> bool:
    """Rewrite one date, if it is worth it; see `compact_closed`.

    The rows before and after are counted; a difference is an error and nothing is switched.
    """
    directory = tables.date_directory(day)
    before = manifest.current(spark, path, [directory]).get(directory, manifest.Manifest(0, [], []))
    standing = manifest.data_files(spark, f"{path}/{directory}")
    appended = [n for n in standing if n not in set(before.replaced)]
    if not appended or len(appended) + len(before.rewritten) < least_files:
        return False
    home, target = f"{path}/{directory}", f"{path}/{manifest.COMPACTED}/{directory}"
    taken = [*(f"{home}/{n}" for n in appended), *(f"{target}/{n}" for n in before.rewritten)]
    rows = tables.scan(spark, path, HISTORY_SCHEMA, ([f"{home}/{n}" for n in appended],
                                                     [f"{target}/{n}" for n in before.rewritten]))
    known = set(manifest.data_files(spark, target))
    parts = -(-sum(storage.size(spark, f) for f in taken) // file_bytes)
    _sorted(rows, parts).write.mode("append").parquet(target)
    rewritten = [n for n in manifest.data_files(spark, target) if n not in known]
    found = spark.read.schema(HISTORY_SCHEMA).parquet(*(f"{target}/{n}" for n in rewritten)).count()
    if found != rows.count():
        raise RuntimeError(f"{directory}: {found} rows rewritten of {rows.count()}")
    manifest.commit(spark, path, directory, manifest.Manifest(
        before.number + 1, rewritten, sorted({*appended, *(n for n in before.replaced if n in standing)})))
    return True


def _sorted(rows: DataFrame, parts: int) -> DataFrame:
    """Ranges of aircraft and time, one per file; the id splits an aircraft with one time."""
    order = ["icao24", "observed_at", "_id"]
    kept = [n for n in HISTORY_SCHEMA.names if n != "ingest_date"]
    return rows.select(*kept).repartitionByRange(max(1, parts), *order).sortWithinPartitions(*order)


def drop_replaced(spark: SparkSession, path: str, older_than: datetime) -> int:
    """Delete files that a manifest committed before ``older_than`` (UTC) leaves out; returns how many.

    Readers opened after that time are undisturbed. Files of failed rewritings go too, once they
    are that old.
    """
    stamps = storage.written(spark, f"{path}/{manifest.MANIFESTS}")
    dropped = 0
    for directory, now in manifest.current(spark, path).items():
        if stamps[f"{directory}.{now.number}.json"] >= older_than:
            continue
        target = f"{path}/{manifest.COMPACTED}/{directory}"
        stray = [n for n, at in storage.written(spark, target).items() if n not in set(now.rewritten) and at < older_than]
        gone = [*(f"{path}/{directory}/{n}" for n in now.replaced if storage.exists(spark, f"{path}/{directory}/{n}")),
                *(f"{target}/{n}" for n in stray if not n.startswith(("_", ".")))]
        for name in gone:
            storage.delete(spark, name)
        dropped += len(gone)
        for number in manifest.numbers(spark, path)[directory][:-1]:
            manifest.forget(spark, path, directory, number)
    return dropped
