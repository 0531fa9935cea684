"""Timestamps: UTC wall time at millisecond precision.

Conversions between instants and wall time use the session zone, which ``configure`` sets
to UTC.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

#: Extended ISO-8601 date or date-time that a cast to TIMESTAMP reads as is.
_ISO_SHAPE = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"(T\d{2}(:\d{2}(:\d{2}([.]\d+)?)?)?(Z|[+-]\d{2}(:\d{2}(:\d{2})?)?)?)?\z"
)

#: Rewrites of other accepted spellings (basic forms, odd separators) to the extended form.
_ISO_REWRITES = (
    (r"^(\d{4})(\d{2})(\d{2})(?=\D|\z)", "$1-$2-$3"),
    (r"^(.{10})Z\z", "$1T00:00:00Z"),
    (r"^(.{10})(?s:.)", "$1T"),
    (r"T(\d{2})(\d{2})(\d{2})(?=[.,Z+-]|\z)", "T$1:$2:$3"),
    (r"T(\d{2})(\d{2})(?=[.,Z+-]|\z)", "T$1:$2"),
    # A decimal mark with nothing behind it before an offset; a fraction is one of a second.
    (r"(T[\d:]+)[.,](?=[Z+-])", "$1"),
    (r"(T\d{2})[.,](?=\d)", "$1:00:00."),
    (r"(T\d{2}:\d{2})[.,](?=\d)", "$1:00."),
    (r"(T\d{2}:\d{2}:\d{2}),", "$1."),
    (r"(T.*[+-]\d{2})(\d{2})(\d{2})\z", "$1:$2:$3"),
    (r"(T.*[+-]\d{2})(\d{2})\z", "$1:$2"),
    # The cast wants whole times before an offset.
    (r"(T\d{2})(?=Z|[+-])", "$1:00"),
    (r"(T\d{2}:\d{2})(?=Z|[+-])", "$1:00"),
)


def as_of_column(as_of) -> Column:
    """Reference time as a column: a ``datetime``, a column, or a one-cell DataFrame."""
    if isinstance(as_of, DataFrame):
        return as_of.scalar()
    if isinstance(as_of, datetime):
        return F.lit(as_of.replace(tzinfo=None)).cast("timestamp_ntz")
    return as_of


def minutes(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def hours(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def seconds(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n).cast("decimal(18,6)"))


def from_millis(ms: Column) -> Column:
    """Epoch milliseconds as UTC wall time."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def to_millis(ts: Column) -> Column:
    """UTC wall time as epoch milliseconds."""
    return F.unix_millis(ts.cast("timestamp"))


def from_epoch_seconds(value: Column) -> Column:
    """Whole or fractional epoch seconds as UTC wall time, cut to milliseconds."""
    return from_millis(F.floor(value.cast("decimal(20,6)") * 1000).cast("bigint"))


def instant_to_utc(ts: Column) -> Column:
    """A ``TIMESTAMP`` instant as UTC wall time, cut to milliseconds."""
    return F.date_trunc("MILLISECOND", ts).cast("timestamp_ntz")


def iso_utc(ts: Column) -> Column:
    """UTC wall time as ISO-8601 with an explicit offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


def _widen(text: Column) -> Column:
    for pattern, replacement in _ISO_REWRITES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to UTC wall time at millisecond precision; null when malformed.

    Text without an offset is read as UTC, which is the session zone ``configure`` sets.
    The common extended form takes one pattern test and one cast; only other spellings
    pass through the rewriting.
    """
    def read(candidate: Column) -> Column:
        return F.when(candidate.rlike(_ISO_SHAPE), candidate.try_cast("timestamp"))

    return instant_to_utc(F.coalesce(read(text), read(_widen(text))))


def timestamp_seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, cut toward zero."""
    return F.timestamp_diff("SECOND", start, end)
