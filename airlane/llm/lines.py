"""Removal of lines that many sites share, with DataFrame functions only.

Every line hash gets a HyperLogLog sketch of the sites it stands on; sketches of map tasks merge by
aggregation. Lines whose estimate is near the threshold get an exact distinct count.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlane.llm.common import packed, stored, text_hash

#: Sites a line must stand on to be boilerplate; buckets of a sketch as a power of two.
MIN_SITES, LG_BUCKETS = 5, 12


def line_table(docs: DataFrame, site: str = "source") -> DataFrame:
    """``doc_id, text_hash, site, at, a, b``: every line with a non-blank character, as two hashes."""
    lines = docs.select("doc_id", text_hash().alias("text_hash"), F.col(site).alias("site"),
                        F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return lines.where("trim(BOTH ' \t\r' FROM line) <> ''").select(
        "doc_id", "text_hash", F.struct(F.col("site").isNull().alias("none"), F.coalesce("site", F.lit("")).alias("name")).alias("site"),
        "at", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """``a, b`` of the lines that stand on at least ``min_sites`` sites; a null site is one site."""
    slack = max(1.0, 4 * 1.04 / math.sqrt(1 << lg_buckets) * min_sites)
    key = F.xxhash64("site")
    estimates = stored(lines.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(key, F.lit(lg_buckets))).alias("sites"))
        .where(F.col("sites") >= min_sites - slack), "line-sites")
    sure = estimates.where(F.col("sites") > min_sites + slack).select("a", "b")
    near = estimates.where(F.col("sites") <= min_sites + slack).select("a", "b")
    exact = (lines.join(near, ["a", "b"]).select("a", "b", "site").distinct()
             .groupBy("a", "b").count().where(F.col("count") >= min_sites).select("a", "b"))
    return stored(sure.unionByName(exact), "shared-lines")


def without_shared_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                         lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """The documents with ``n_lines``, ``n_removed`` (both of non-blank lines) and ``cleaned`` text.

    Every line that stands on ``min_sites`` sites or more, over all documents, goes from every
    document; the others keep their order and are joined by line feeds. Blank lines always stay; lines
    differ by any character. A null text has no lines and stays null, an empty one stays empty. Rows
    repeated under one id are cleaned each; result columns replace columns of the same names.
    """
    lines = stored(line_table(docs, site), "lines")
    cuts = (lines.join(shared_lines(lines, min_sites, lg_buckets), ["a", "b"])
            .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("at")).alias("cuts")))
    cuts = cuts.select(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                                "text_hash").alias("key"), "cuts")
    kept = docs.drop("n_lines", "n_removed", "cleaned")
    keyed = packed(kept, key=F.struct(
        F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), text_hash().alias("text_hash")))
    text = F.col("row.text")
    split = F.split(text, "\n")
    none = F.array().cast("array<int>")
    cut = F.coalesce("cuts", none)
    # Runs of lines between two cuts; each run is copied once, however many there are.
    froms = F.concat(F.array(F.lit(-1)), cut)
    upto = F.concat(cut, F.array(F.size(split)))
    runs = F.transform(F.arrays_zip(froms.alias("f"), upto.alias("u")),
                       lambda r: F.slice(split, r["f"] + 2, r["u"] - r["f"] - 1))
    filled = F.size(F.filter(split, lambda s: F.trim(s, F.lit(" \t\r")) != ""))
    made = F.struct(F.when(text.isNull(), 0).otherwise(filled).cast("long").alias("n_lines"),
                    F.coalesce(F.size("cuts"), F.lit(0)).cast("long").alias("n_removed"),
                    F.when(F.col("cuts").isNull(), text).otherwise(F.array_join(F.flatten(runs), "\n")).alias("cleaned"))
    return keyed.join(cuts, "key", "left").select("row", made.alias("made")).select("row.*", "made.*")
