"""Files and directories through the session's Hadoop file systems."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import SparkSession


def _location(spark: SparkSession, path: str):
    """A path and its file system, as Hadoop objects."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _location(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory, none when it does not exist."""
    return list(written(spark, path))


def written(spark: SparkSession, path: str) -> dict[str, datetime]:
    """Names of the entries of a directory with the UTC times of their last change."""
    root, files = _location(spark, path)
    if not files.exists(root):
        return {}
    at = lambda s: datetime(1970, 1, 1) + timedelta(milliseconds=s.getModificationTime())
    return {s.getPath().getName(): at(s) for s in files.listStatus(root)}


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files below a directory."""
    where, files = _location(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def delete(spark: SparkSession, path: str) -> None:
    where, files = _location(spark, path)
    files.delete(where, True)


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file, seen whole or not at all; fails when it is there already."""
    where, files = _location(spark, path)
    draft, _ = _location(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)
