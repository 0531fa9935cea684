"""Stored history and live tables: reading, appending, counting."""

from __future__ import annotations

import tempfile
import uuid
from bisect import bisect_left
from datetime import date, datetime, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from airlane.operators import latest, retention
from airlane.schemas import HISTORY_RETENTION_HOURS, HISTORY_SCHEMA, MEMBER_SCHEMA, STORED_SCHEMA
from airlane.sources import manifest, storage
from airlane.sources.manifest import BY_DATE, NO_DATE

#: Ids of a batch that are sent to all tasks reading stored ids, about 100 MB at most; more are joined by shuffling.
MOST_SENT_IDS = 500_000


#: Where reading goes on after a version of a live table: a row per log partition.
POSITION_SCHEMA = StructType([StructField("topic", StringType()), StructField("partition", IntegerType()),
                              StructField("next_offset", LongType())])

exists, _names, _bytes, _delete = storage.exists, storage.names, storage.size, storage.delete


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A local session without that setting gets a temporary folder of its own; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="airlane-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to the shared folder, see `shared_folder`, and read back.

    For plans that scan their input more than once and whose input is dear to compute. The folder's
    owner empties it.
    """
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema=STORED_SCHEMA) -> DataFrame:
    """A stored table by its explicit schema; filters and projections reach the files.

    ``HISTORY_SCHEMA`` also reads the members outside the typed event. Of history whose dates have
    been rewritten, the live files are read, see `manifest`.
    """
    if exists(spark, f"{path}/{manifest.MANIFESTS}"):
        return scan(spark, path, schema, manifest.live(spark, path))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scan(spark: SparkSession, path: str, schema: StructType, live: tuple[list[str], list[str]]) -> DataFrame:
    """History rows of some appended and some rewritten files; filters and projections reach both."""
    bases = path, f"{path}/{manifest.COMPACTED}"
    parts = [spark.read.schema(schema).option("basePath", base).parquet(*where).select(*schema.names)
             for base, where in zip(bases, live) if where]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def write_history(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write history rows by ingestion date, ordered so that row groups prune by aircraft.

    The date directories serve retention and age filters; inside a file rows are sorted by
    aircraft and time, which is the access path of history reads. Rebalancing by date gives
    files of the advisory size: small dates share a task and a large one is split, so
    neither many tiny files nor one oversized task results. Nothing is checked for being
    stored already; see `append_history`.
    """
    kept = [f.name for f in HISTORY_SCHEMA if f.name in rows.columns and f.name != "ingest_date"]
    dated = rows.select(*kept, F.to_date("ingested_at").alias("ingest_date"))
    (
        dated.hint("rebalance", "ingest_date")
        .sortWithinPartitions("ingest_date", "icao24", "observed_at")
        .write.mode(mode).partitionBy("ingest_date").parquet(path)
    )


def append_history(rows: DataFrame, path: str,
                   horizon_hours: int | None = HISTORY_RETENTION_HOURS) -> None:
    """Append the rows, one per id, whose ids are not stored yet.

    An id counts as stored for a row if it stands in a date directory at most ``horizon_hours``,
    in whole days, before or after the row's own ingestion date (``None``: in any), so repeating
    an append adds nothing, and a row with an odd clock reads the days around that clock alone.
    Rows without an ingestion time are compared with rows without one. The files of other dates
    are not opened. Of the dates that may hold an id, the id column is read where it lies: the
    batch's ids go to it as long as they are few, and only ids found come back.
    """
    spark = rows.sparkSession
    asked = rows.select(F.col("_id").alias("_asked"), F.to_date("ingested_at").alias("_day"))
    counted = asked.groupBy("_day").count().collect()  # a row per date in the batch
    within = None if horizon_hours is None else -(-horizon_hours // 24)
    near = _dates_near(spark, path, [r["_day"] for r in counted], within)
    if near:
        if sum(r["count"] for r in counted) <= MOST_SENT_IDS:
            asked = F.broadcast(asked)
        known = _same_window(stored_ids(spark, path, near), asked, within)
        rows = rows.join(known, (rows["_id"] == known["_asked"]) & F.to_date(rows["ingested_at"]).eqNullSafe(known["_day"]),
                         "left_anti")
    write_history(rows, path)


def _dates_near(spark: SparkSession, path: str, days: list[date | None], within: int | None) -> list[date | None]:
    """Stored dates (None: rows without one) at most ``within`` days from one of ``days``."""
    stored = dates(spark, path)
    if within is None:
        return stored
    wanted = sorted(d for d in days if d is not None)
    far = lambda d: min((abs((d - w).days) for w in _neighbours(wanted, d)), default=within + 1)
    return [d for d in stored if (None in days if d is None else far(d) <= within)]


def _neighbours(days: list[date], day: date) -> list[date]:
    """The days next to ``day`` in a sorted list."""
    at = bisect_left(days, day)
    return days[max(0, at - 1):at + 1]


def _same_window(stored: DataFrame, asked: DataFrame, within: int | None) -> DataFrame:
    """``_asked, _day`` of the rows of a batch whose ids are stored in their window."""
    match = F.col("_id") == F.col("_asked")
    if within is not None:
        apart = F.abs(F.date_diff("ingest_date", "_day")) <= within
        match = match & (apart | (F.col("ingest_date").isNull() & F.col("_day").isNull()))
    return stored.join(asked, match).select("_asked", "_day").distinct()


def stored_ids(spark: SparkSession, path: str, dates: list[date | None]) -> DataFrame:
    """``_id, ingest_date`` of the history in some date directories; no other directory is listed or read."""
    schema = StructType([HISTORY_SCHEMA["_id"], HISTORY_SCHEMA["ingest_date"]])
    return scan(spark, path, schema, manifest.live(spark, path, [date_directory(d) for d in dates]))


def date_directory(day: date | None) -> str:
    return f"{BY_DATE}{NO_DATE if day is None else day.isoformat()}"


def dates(spark: SparkSession, path: str) -> list[date | None]:
    """Dates of the history's directories, in order; None, last, for rows without an ingestion time."""
    names = [n.removeprefix(BY_DATE) for n in _names(spark, path) if n.startswith(BY_DATE)]
    return [*sorted(date.fromisoformat(n) for n in names if n != NO_DATE), *([None] if NO_DATE in names else [])]


def drop_expired(spark: SparkSession, path: str, before: datetime) -> list[str]:
    """Delete the date directories that lie wholly before a time; returns their dates.

    Any date counts, also one that a wrong clock has set. Rows without an ingestion time stay. Of a
    rewritten date, an interrupted deletion leaves the directory, which is found again.
    """
    expired = [d for d in dates(spark, path) if d is not None and d < before.date()]
    rewritten = manifest.numbers(spark, path) if expired else {}
    for day in expired:
        directory = date_directory(day)
        known = rewritten.get(directory, [])
        if known:
            gone = manifest.data_files(spark, f"{path}/{directory}")
            manifest.commit(spark, path, directory, manifest.Manifest(known[-1] + 1, [], gone))
            _delete(spark, f"{path}/{manifest.COMPACTED}/{directory}")
        _delete(spark, f"{path}/{directory}")
        for number in [*known, *([known[-1] + 1] if known else [])]:
            manifest.forget(spark, path, directory, number)
    return [d.isoformat() for d in expired]


# -- the live table: a base and the changes of the batches since ---------------------------------------


class LiveFiles(NamedTuple):
    """What a path holds, committed parts only: numbers of bases, and of changes their directory and cut."""

    bases: list[int]
    changes: dict[int, tuple[str, datetime | None]]

    def of(self, version: int | None = None) -> tuple[int | None, list[int]]:
        """The base and the changes that make up a version (default: the newest)."""
        version = max([*self.bases, *self.changes], default=-1) if version is None else version
        base = max((b for b in self.bases if b <= version), default=None)
        return base, sorted(c for c in self.changes if c <= version and (base is None or c > base))

    def cut(self, changes: list[int]) -> datetime | None:
        """No row ingested up to this time is left."""
        return max((self.changes[c][1] for c in changes if self.changes[c][1] is not None), default=None)


def live_files(spark: SparkSession, path: str) -> LiveFiles:
    bases, changes = [], {}
    for name in _names(spark, path):
        kind, _, rest = name.partition("=")
        if kind in ("version", "changes") and exists(spark, f"{path}/{name}/_SUCCESS"):
            number, _, cut = rest.partition(".")
            if kind == "version":
                bases.append(int(number))
            else:
                changes[int(number)] = name, datetime(1970, 1, 1) + timedelta(milliseconds=int(cut)) if cut else None
    return LiveFiles(sorted(bases), changes)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions of a live table, oldest first; each is a base or a batch's changes."""
    files = live_files(spark, path)
    return sorted({*files.bases, *files.changes})


def _changed(spark: SparkSession, where: list[str], schema) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField("_version", LongType())])).parquet(*where)


def read_live(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A committed version, the newest by default; empty when there is none.

    Of an aircraft in changes, the newest changed row stands for the base's. Changes are few
    beside the base, see `compact_live`; the join that leaves their aircraft out of it is left to
    Spark's size-checked choice.
    """
    files = live_files(spark, path)
    base, changes = files.of(version)
    rows = spark.createDataFrame([], STORED_SCHEMA) if base is None else read_table(spark, f"{path}/version={base}")
    if not changes:
        return rows
    changed = _changed(spark, [f"{path}/{files.changes[c][0]}" for c in changes], STORED_SCHEMA)
    newest = _newest_changes(changed)
    rows = rows.join(newest, "icao24", "left_anti").select(*STORED_SCHEMA.names).unionByName(
        changed.join(newest, ["icao24", "_version"], "left_semi").select(*STORED_SCHEMA.names))
    cut = files.cut(changes)
    return rows if cut is None else rows.where(F.col("ingested_at").isNull() | (F.col("ingested_at") > F.lit(cut)))


def _newest_changes(changed: DataFrame) -> DataFrame:
    return changed.groupBy("icao24").agg(F.max("_version").alias("_version"))


def read_members(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Open members of a committed version: ``icao24, name, json, observed_at``.

    A batch's changes hold all members of the aircraft they hold.
    """
    files = live_files(spark, path)
    base, changes = files.of(version)
    members = (spark.createDataFrame([], MEMBER_SCHEMA) if base is None
               else read_table(spark, f"{path}/members/version={base}", MEMBER_SCHEMA))
    if not changes:
        return members
    names = [files.changes[c][0] for c in changes]
    newest = _newest_changes(_changed(spark, [f"{path}/{n}" for n in names], STORED_SCHEMA))
    changed = _changed(spark, [f"{path}/members/{n}" for n in names], MEMBER_SCHEMA)
    members = members.join(newest, "icao24", "left_anti").select(*MEMBER_SCHEMA.names).unionByName(
        changed.join(newest, ["icao24", "_version"], "left_semi").select(*MEMBER_SCHEMA.names))
    if files.cut(changes) is None:
        return members
    return members.join(read_live(spark, path, version).select("icao24"), "icao24", "left_semi")


def read_live_documents(spark: SparkSession, path: str) -> DataFrame:
    """The newest version with each aircraft's open members as a map ``extra``, as archives hold it."""
    members = latest.extra_map(read_members(spark, path))
    return read_live(spark, path).join(members, "icao24", "left").select(*STORED_SCHEMA.names, "extra")


def write_live(rows: DataFrame, path: str, members: DataFrame | None = None, version: int | None = None) -> int:
    """Write a whole live table as a base, the next version of the path; returns the version.

    The number comes from the path, so no writer, whatever its checkpoint, can hide behind
    versions that are there. Members are written first: the rows commit the version. One writer
    at a time.
    """
    spark = rows.sparkSession
    version = max(versions(spark, path), default=-1) + 1 if version is None else version
    if members is None:
        members = spark.createDataFrame([], MEMBER_SCHEMA)
    members.select(*MEMBER_SCHEMA.names).write.mode("overwrite").parquet(f"{path}/members/version={version}")
    rows.select(*STORED_SCHEMA.names).write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def write_changes(rows: DataFrame, members: DataFrame, path: str, cut: datetime | None = None,
                  positions: DataFrame | None = None) -> int:
    """Write the rows that a batch changed, with all members of their aircraft, as the next version.

    Rows ingested up to ``cut`` leave the table with this version; the cut never goes back. What
    is written follows the batch, not the table. Members first, the rows commit, as for a base.
    ``positions``: the next offset of every log partition in the batch, see `read_positions`.
    """
    spark = rows.sparkSession
    version = max(versions(spark, path), default=-1) + 1
    files = live_files(spark, path)
    before = files.cut(files.of()[1])
    cut = max((c for c in (cut, before) if c is not None), default=None)
    name = f"changes={version}" + ("" if cut is None else f".{(cut - datetime(1970, 1, 1)) // timedelta(milliseconds=1)}")
    if positions is not None:
        told = retention.join_positions(read_positions(spark, path), positions).select(*POSITION_SCHEMA.names)
        told.coalesce(1).write.mode("overwrite").parquet(f"{path}/positions/version={version}")
    for part, schema, where in ((members, MEMBER_SCHEMA, f"{path}/members/{name}"), (rows, STORED_SCHEMA, f"{path}/{name}")):
        part.select(*schema.names, F.lit(version).cast("long").alias("_version")).write.mode("overwrite").parquet(where)
    return version


def read_positions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``topic, partition, next_offset``: a committed version, the newest by default, holds the log before these offsets.

    A partition the version has not met has no row. A version written whole, such as a restored
    archive, has none at all: whoever goes on from it reads the log from its start.
    """
    version = max(versions(spark, path), default=None) if version is None else version
    where = f"{path}/positions/version={version}"
    if version is None or not exists(spark, f"{where}/_SUCCESS"):
        return spark.createDataFrame([], POSITION_SCHEMA)
    return spark.read.schema(POSITION_SCHEMA).parquet(where)


def compact_live(spark: SparkSession, path: str, share: float = 0.25, most: int = 64, least: int = 4) -> int | None:
    """Fold the newest base and the changes since into a base of the same version, if there are many.

    Many are ``most`` batches, or ``least`` and more than ``share`` of the base's bytes. Readers of
    any version see the same rows before, during and after. Returns the version folded.
    """
    files = live_files(spark, path)
    base, changes = files.of()
    if len(changes) < least:
        return None
    size = lambda name: _bytes(spark, f"{path}/{name}") + _bytes(spark, f"{path}/members/{name}")
    of_base = 0 if base is None else size(f"version={base}")
    if len(changes) < most and sum(size(files.changes[c][0]) for c in changes) <= share * of_base:
        return None
    return write_live(read_live(spark, path), path, read_members(spark, path), changes[-1])


def drop_old_versions(spark: SparkSession, path: str, keep: int = 3, fold: bool = True) -> list[int]:
    """Delete all but the newest versions; readers of the kept ones are undisturbed.

    ``fold``: write the oldest kept one as a base, so that none before it is needed; otherwise
    the base it stands on, and what follows that, stay too.
    """
    known = versions(spark, path)
    kept = known[-keep:]
    if not kept:
        return []
    files = live_files(spark, path)
    first, changes = files.of(kept[0])
    if fold and changes and known[:-keep]:
        first = write_live(read_live(spark, path, kept[0]), path, read_members(spark, path, kept[0]), kept[0])
    dropped = [v for v in known if first is not None and v < first]
    for version in dropped:
        for name in [f"version={version}", *([files.changes[version][0]] if version in files.changes else [])]:
            _delete(spark, f"{path}/{name}")
            _delete(spark, f"{path}/members/{name}")
        _delete(spark, f"{path}/positions/version={version}")
    return dropped


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether a path holds no stored rows, neither as files nor as a live table."""
    names = _names(spark, path)
    if any(n.startswith(("version=", "changes=")) for n in names):
        return read_live(spark, path).isEmpty()
    return not names or read_table(spark, path).isEmpty()


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and, as table ``*``, over all of them."""
    counted = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, rows in tables.items()
    ]
    union = counted[0]
    for part in counted[1:]:
        union = union.unionAll(part)
    both = union.select(F.explode(F.array(F.col("table"), F.lit("*"))).alias("table"), "rows")
    return both.groupBy("table").agg(F.sum("rows").alias("rows"))
