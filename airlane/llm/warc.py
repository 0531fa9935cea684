"""Deduplicated web archives: revisit records for payloads that another record holds.

Headers are narrow rows without payloads. They are aggregated by payload digest to choose each
payload's response record; the other records join it and are written as revisits without their
payload. Archives are written whole by tasks, with fresh headers and every record a gzip member of its
own, and read back the same way.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlane.llm.common import prepare, scratch, stored

#: Least payload, in bytes, that a revisit may stand for; size at which an archive is closed; record date.
LEAST_BYTES, FILE_BYTES, DATE = 1000, 64 << 20, "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def headers(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest`` (bare hexadecimal SHA-1); null html is empty."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(F.col("page_id").cast("long"), "url", F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("payload_digest"))


def resolved(heads: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Each distinct header once, with ``times`` (rows), ``responses`` (of these), ``refers_to``, ``refers_to_url``.

    Of headers with one digest and length, one row of the largest page id (null is smallest; ties go to
    the larger url) is the response, all others revisit it, rows that repeat it whole included. Payloads
    below ``least_bytes`` are all responses.
    """
    own = F.struct(F.col("page_id").isNotNull().alias("has_id"), "page_id", F.col("url").isNotNull().alias("has_url"), "url")
    distinct = heads.groupBy("page_id", "url", "payload_bytes", "payload_digest").agg(F.count("*").alias("times")).withColumn("own", own)
    best = (distinct.where(F.col("payload_bytes") >= least_bytes)
            .groupBy("payload_digest", "payload_bytes").agg(F.max("own").alias("best")))
    joined = distinct.join(best, ["payload_digest", "payload_bytes"], "left")
    responses = F.when(F.col("best").isNull(), F.col("times")).when(F.col("own") == F.col("best"), 1).otherwise(0)
    return joined.select("page_id", "url", "payload_bytes", "payload_digest", "times", responses.cast("long").alias("responses"),
                         F.col("best.page_id").alias("refers_to"), F.col("best.url").alias("refers_to_url"))


def record_id(page_id: int | None, url: str | None, digest: str, again: int = 1) -> str:
    """A response's id, by its page, address and payload, and by its number among rows that agree in these."""
    name = f"{page_id} {url} {digest}" + f" {again}" * (again > 1)
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _uri(url: str | None) -> str:
    return quote(url or "urn:unknown", safe=":/?#[]@!$&'()*+,;=%~-._")


def record(row: dict, payload: bytes | None) -> bytes:
    """One WARC/1.1 record; a revisit has the response headers but no payload."""
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n").encode()
    own = record_id(row["page_id"], row["url"], row["payload_digest"], row["again"])
    fields = [("WARC-Type", row["record_type"]), ("WARC-Target-URI", _uri(row["url"])), ("WARC-Date", DATE),
              ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if row["record_type"] == "revisit":
        original = record_id(row["refers_to"], row["refers_to_url"], row["payload_digest"])
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'revisit ' + own)}>"
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", original),
                   ("WARC-Refers-To-Target-URI", _uri(row["refers_to_url"])), ("WARC-Refers-To-Date", DATE)]
        payload = b""
    if row["page_id"] is not None:
        fields.append(("X-Page-Id", str(row["page_id"])))
    body = http + (payload or b"")
    fields += [("WARC-Record-ID", own), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + body + b"\r\n\r\n"


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of an archive."""

    def line() -> bytes:
        out = stream.readline()
        if not out.endswith(b"\r\n"):
            raise ValueError("damaged archive")
        return out[:-2]

    while first := stream.readline():
        if first != b"WARC/1.1\r\n":
            raise ValueError("not a WARC record")
        fields = {}
        while text := line():
            name, _, value = text.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        n = int(fields["content-length"])
        block = stream.read(n)
        if len(block) < n or stream.read(4) != b"\r\n\r\n":
            raise ValueError("damaged archive")
        yield fields, block


def write_archives(pages: DataFrame, uri: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (``page_id, url, html``) to archives below ``uri``.

    Returns the stored list ``file string, records long``. Rows repeated under one id are a record each.
    """
    spark = prepare(pages.sparkSession)
    key = F.struct(F.col("page_id").isNull().alias("no_id"), F.coalesce("page_id", F.lit(0).cast("long")).alias("id"),
                   F.col("url").isNull().alias("no_url"), F.coalesce("url", F.lit("")).alias("url"), "payload_digest").alias("row_key")
    kinds = resolved(stored(headers(pages), "headers"), least_bytes).select(key, "responses", "refers_to", "refers_to_url")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    body = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    again = F.row_number().over(Window.partitionBy("row_key").orderBy("row_key")).alias("again")
    joined = body.withColumn("row_key", key).join(kinds, "row_key").select("*", again)
    kind = F.when(F.col("again") <= F.col("responses"), "response").otherwise("revisit")
    rows = joined.select("page_id", "url", "payload_digest", "payload_bytes", kind.alias("record_type"), "refers_to",
                         "refers_to_url", "again", F.when(kind == "response", F.col("payload")).alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, root = pyarrow.fs.FileSystem.from_uri(uri)
        system.create_dir(root, recursive=True)
        out, number, made = None, 0, []

        def close():
            nonlocal out, number
            out.close()
            system.move(part, f"{root}/{name}.warc.gz")  # a repeated task replaces its file
            made.append({"file": name, "records": count})
            out, number = None, number + 1

        for batch in batches:
            payloads = batch.column("payload")
            for row, body_of in zip(batch.drop_columns(["payload"]).to_pylist(), payloads):
                if out is None:
                    name, count, size = f"{task.partitionId():06d}-{number:05d}", 0, 0
                    part = f"{root}/.{name}.{task.taskAttemptId()}"
                    out = system.open_output_stream(part)
                data = gzip.compress(record(row, body_of.as_py()), mtime=0)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return stored(rows.mapInArrow(write, "file string, records long"), "archives")


def read_archives(spark: SparkSession, files: DataFrame, uri: str) -> DataFrame:
    """Read the archives back, a file per row of the list, and join revisits to their responses.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``; for a revisit, payload
    and page are those of the response it refers to. A payload that contradicts its digest raises.
    """
    n = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pyarrow.fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with system.open_input_file(f"{root}/{name}.warc.gz") as raw:
                    for fields, block in records(io.BufferedReader(gzip.GzipFile(fileobj=raw, mode="rb"), 1 << 20)):
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        revisit = fields["warc-type"] == "revisit"
                        if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError("payload contradicts its digest")
                        page = fields.get("x-page-id")
                        rows.append({"page_id": None if page is None else int(page), "payload_bytes": None if revisit else len(payload),
                                     "payload_digest": digest, "record_type": fields["warc-type"],
                                     "record_id": fields["warc-record-id"], "refers_to_id": fields.get("warc-refers-to")})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string())]))

    found = stored(files.repartition(min(n, 10_000), "file").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string"), "archive-rows")
    responses = found.where("record_type = 'response'")
    originals = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("original"), F.col("payload_bytes").alias("original_bytes"))
    revisits = found.where("record_type = 'revisit'").select("page_id", "payload_digest", "record_type", "refers_to_id")
    revisits = revisits.join(originals, "refers_to_id", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns).unionByName(
        revisits.select("page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type",
                        F.col("original").alias("refers_to")))


def archived(pages: DataFrame, uri: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the archives (below a new scratch folder unless ``uri`` is given) and read them back."""
    uri = uri or scratch(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, uri, least_bytes), uri)
