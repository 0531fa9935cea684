"""Dead-letter envelopes for rejected messages."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlane.functions import times
from airlane.operators.validate import ERROR_MESSAGES

# --- fixed values: envelope constants --------------------------------------
ENVELOPE_VERSION = 1
CLASSIFICATION = "permanent"
ERROR_TYPE = "PermanentMessageError"
MESSAGE_LIMIT = 2048


def log_identity() -> Column:
    return F.concat_ws(
        ":", "kafka_topic", F.col("kafka_partition").cast("string"),
        F.col("kafka_offset").cast("string"),
    )


def base64_text(value: Column) -> Column:
    """Base64 text of bytes or text on one line, null for null."""
    return F.replace(F.base64(value), F.lit("\r\n"), F.lit(""))


def error_message(code: Column) -> Column:
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in ERROR_MESSAGES.items())
    return F.left(F.coalesce(F.try_element_at(F.create_map(*pairs), code), code),
                  F.lit(MESSAGE_LIMIT))


def envelopes(rejected: DataFrame, consumer_group: str, as_of, attempts: int = 1) -> DataFrame:
    """One nested envelope per rejected row of ``validate``; the raw bytes survive exactly."""
    headers = F.transform(
        F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>")),
        lambda h: F.struct(
            h["key"].alias("name"), base64_text(h["value"]).alias("value_base64")
        ),
    )
    return rejected.select(
        F.lit(ENVELOPE_VERSION).alias("schema_version"),
        log_identity().alias("dlq_id"),
        times.iso_utc(times.as_of_column(as_of)).alias("failed_at"),
        F.lit(consumer_group).alias("consumer_group"),
        F.lit(attempts).alias("attempts"),
        F.struct(
            F.lit(CLASSIFICATION).alias("classification"),
            F.lit(ERROR_TYPE).alias("type"),
            error_message(F.col("error_code")).alias("message"),
        ).alias("error"),
        F.struct(
            F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").alias("partition"),
            F.col("kafka_offset").alias("offset"),
            F.col("timestampType").alias("timestamp_type"),
            F.unix_millis("timestamp").alias("timestamp_ms"),
            base64_text(F.col("key")).alias("key_base64"),
            headers.alias("headers"),
        ).alias("source"),
        F.struct(
            F.lit("base64").alias("encoding"), base64_text(F.col("value")).alias("data")
        ).alias("payload"),
    )


def to_messages(envelope_rows: DataFrame) -> DataFrame:
    """Envelopes as keyed messages for the dead-letter log."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return envelope_rows.select(
        F.col("dlq_id").cast("binary").alias("key"), value.cast("binary").alias("value")
    )
