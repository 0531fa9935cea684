"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Fingerprints with at most 2 differing bits share at least 6 of their 8 positional bytes. Bytes are
listed in four pairs; at least two of the pairs agree, so the index has a posting list for each choice
of two pairs and their 4 bytes. Pairs within a list are tallied by shared positional bytes, those below
6 are dropped, the others verified. A long list is not paired: fingerprints within one bit of the same
value are within 2 bits of each other, so linking each with the smallest of these loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import packed, prepare, schema_with, stored, text_hash, texts_of, with_columns
from airlane.llm.components import components

#: Words of a shingle, seed of its hash, most differing bits, least shared bytes.
SHINGLE, SEED, MOST_BITS, LEAST_BYTES = 3, 42, 2, 6
#: Longest posting list whose pairs are formed; it costs as much as the way for longer ones.
PAIRED = 33
#: Shingles tallied at a time.
TALLY = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits of a text; see `fingerprints`."""
    words = text.lower().split()
    if not words:
        return 0
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    total = max(1, len(words) - shingle + 1)
    for at in range(0, total, TALLY):
        part = words[at:at + TALLY + shingle - 1]
        if len(part) <= shingle:
            hashes = [digest(b" ".join(part), seed)]
        else:
            hashes = [digest(b" ".join(s), seed) for s in zip(*[part[k:] for k in range(shingle)])]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, carry: bool = True) -> DataFrame:
    """The documents with ``simhash``, a long of 64 bits.

    A-Z are lower-cased, words end at ASCII white space; shingles, repeats included, are hashed by
    XXH64; a bit is 1 if set in over half the hashes. Fewer words than a shingle has are one shingle;
    no words (null included) give 0. A column ``simhash`` of the input is replaced; ``carry``: keep the text.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch.column("text"))], dtype=np.uint64)
            yield with_columns(batch, ["simhash"], [pa.array(values.view(np.int64))], carry)

    prepare(docs.sparkSession)
    return docs.mapInArrow(marked, schema_with(docs, "simhash long", carry))


def _byte(value: Column, at: int) -> Column:
    return F.shiftrightunsigned(value, 8 * at).bitwiseAND(F.lit(255))


def _shared_bytes(a: Column, b: Column) -> Column:
    """How many positional bytes agree."""
    return sum(((_byte(a, k) == _byte(b, k)).cast("int") for k in range(8)), F.lit(0))


def _verified(pairs: DataFrame) -> DataFrame:
    tallied = pairs.where(_shared_bytes(F.col("u"), F.col("v")) >= LEAST_BYTES)
    return tallied.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MOST_BITS)


def links(prints: DataFrame, paired: int = PAIRED) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (column ``simhash``) whose components are those of all links."""
    halves = [F.shiftrightunsigned("simhash", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    lists = F.array(*[F.struct(F.lit(10 * a + b).alias("pairs"), (halves[a] * 65536 + halves[b]).alias("bytes"))
                      for a, b in combinations(range(4), 2)])
    postings = prints.select("simhash", F.explode(lists).alias("list")).select("simhash", "list.*")
    long_enough = postings.groupBy("pairs", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    listed = stored(postings.join(long_enough, ["pairs", "bytes"]), "postings")
    short = listed.where(F.col("n") <= paired).drop("n")
    mates = short.select("pairs", "bytes", F.col("simhash").alias("v"))
    near = _verified(short.withColumnRenamed("simhash", "u").join(mates, ["pairs", "bytes"]).where("u > v").select("u", "v"))
    # One-bit neighbourhoods, over the bits that the list leaves open.
    flips = F.array(F.lit(0).cast("long"), *[F.when(~F.col("pairs").isin([10 * a + b for a, b in combinations(range(4), 2) if bit // 16 in (a, b)]),
                                                    F.lit((1 << bit) - (1 << 64 if bit == 63 else 0))) for bit in range(64)])
    near_by = (listed.where(F.col("n") > paired)
               .select("simhash", F.explode(F.array_compact(flips)).alias("flip"))
               .select("simhash", F.col("simhash").bitwiseXOR(F.col("flip")).alias("centre")).distinct())
    # At most 65 fingerprints share a centre.
    least = F.min("simhash").over(Window.partitionBy("centre"))
    starred = _verified(near_by.select(F.col("simhash").alias("u"), least.alias("v")).where("u <> v"))
    return near.unionByName(starred).distinct()


def groups(docs: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``doc_id, h, simhash, component_id`` per row of ``docs``: the smallest id its fingerprint's links reach.

    Equal fingerprints are one node, so copies cost one row each. A null id is never the smallest
    unless a component has no other; repeated rows stay. ``h`` tells texts of one id apart.
    """
    prints = stored(fingerprints(docs.select(F.col("doc_id").cast("long"), text_hash().alias("h"), "text"), carry=False),
                    "fingerprints")
    nodes = stored(prints.groupBy("simhash").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    found = components(links(nodes.select("simhash"), paired))
    root = F.coalesce("root", "simhash")
    member = nodes.join(found, nodes["simhash"] == found["node"], "left").select("simhash", "least", root.alias("root"))
    member = stored(member, "fingerprint-roots")
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    of = member.join(smallest, "root").select("simhash", "component_id")
    return prints.join(of, "simhash").select("doc_id", "h", "simhash", "component_id")


def without_near_duplicates(docs: DataFrame, paired: int = PAIRED) -> DataFrame:
    """One row per component, that of the smallest id (of rows repeating it, one with the smallest text hash)."""
    found = groups(docs, paired)
    kept = (found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("row"))
            .select(F.struct(F.col("row.none").alias("none"), F.coalesce("row.doc_id", F.lit(0).cast("long")).alias("id"),
                             F.col("row.h").alias("h")).alias("key")))
    keyed = packed(docs, key=F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(
        F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), text_hash().alias("h")))
    # Repeated rows go before the join, so that each task sends one of them.
    place = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    once = keyed.withColumn("place", place).where("place = 1").join(kept, "key")
    return once.select("row.*")
