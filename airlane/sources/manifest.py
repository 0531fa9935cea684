"""Which files of a history are live, by date.

A date without a manifest is all files of its directory. A manifest names rewritten files, kept
under ``_compacted``, and the files of the date's directory that they stand for; files appended to
the directory since are live as well. Manifests are numbered and never changed; the greatest
number of a date counts, so committing one switches all its files at once for readers that open later.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import SparkSession

from airlane.sources import storage

#: Names of the date directories of history; readers of plain directories skip names with an underscore.
BY_DATE, NO_DATE = "ingest_date=", "__HIVE_DEFAULT_PARTITION__"
COMPACTED, MANIFESTS = "_compacted", "_manifest"


class Manifest(NamedTuple):
    number: int
    rewritten: list[str]
    replaced: list[str]


def numbers(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the committed manifests, in order, by date directory."""
    found = defaultdict(list)
    for name in storage.names(spark, f"{path}/{MANIFESTS}"):
        directory, _, number = name.removesuffix(".json").rpartition(".")
        if name.endswith(".json") and directory:
            found[directory].append(int(number))
    return {directory: sorted(known) for directory, known in found.items()}


def current(spark: SparkSession, path: str, directories: Collection[str] | None = None) -> dict[str, Manifest]:
    """The newest manifest of every date directory that has one (default: of all)."""
    newest = {d: known[-1] for d, known in numbers(spark, path).items() if directories is None or d in directories}
    if not newest:
        return {}
    where = [_file(path, d, n) for d, n in newest.items()]
    found = {}
    for row in spark.read.option("wholetext", True).text(where).select("value").collect():  # a row per date
        told = json.loads(row["value"])
        found[told["directory"]] = Manifest(newest[told["directory"]], told["rewritten"], told["replaced"])
    return found


def commit(spark: SparkSession, path: str, directory: str, manifest: Manifest) -> None:
    """Make a manifest its date's newest; fails when another took its number."""
    told = {"directory": directory, "rewritten": manifest.rewritten, "replaced": manifest.replaced}
    storage.create(spark, _file(path, directory, manifest.number), json.dumps(told))


def forget(spark: SparkSession, path: str, directory: str, number: int) -> None:
    storage.delete(spark, _file(path, directory, number))


def live(spark: SparkSession, path: str, directories: Collection[str] | None = None) -> tuple[list[str], list[str]]:
    """Paths of the live appended files, as directories where they are whole, and of the rewritten ones."""
    known = current(spark, path, directories)
    if directories is None:
        directories = sorted({*known, *(n for n in storage.names(spark, path) if n.startswith(BY_DATE))})
    appended, rewritten = [], []
    for directory in directories:
        if directory not in known:
            appended.append(f"{path}/{directory}")
            continue
        # The manifest is read before the directory: what it replaces may be gone, what it misses is listed.
        appended += [f"{path}/{directory}/{n}" for n in data_files(spark, f"{path}/{directory}")
                     if n not in set(known[directory].replaced)]
        rewritten += [f"{path}/{COMPACTED}/{directory}/{n}" for n in known[directory].rewritten]
    return appended, rewritten


def data_files(spark: SparkSession, directory: str) -> list[str]:
    return sorted(n for n in storage.names(spark, directory) if not n.startswith(("_", ".")))


def _file(path: str, directory: str, number: int) -> str:
    return f"{path}/{MANIFESTS}/{directory}.{number}.json"
