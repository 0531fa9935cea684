"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents are all to be copied ``target / size`` times. The whole part is given; the
fractions are rounded in pairs: words are moved at random from one to the other, keeping their sum and
each one's expectation, until one fraction is 0 or 1. Every group leaves one fraction at most, and the
groups' residuals are paired again, level by level, up to one per source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import packed, stored, text_hash

#: Weights of the sources in order, repeating; share of all words to take; most copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), (3, 2), 2
#: Documents of a group, and residuals of a group at a higher level.
GROUP_ROWS, FAN_IN = 20_000, 64
WORDS = r"[^ \t-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """``none, name, size, target`` of each source from ``none, name, size``.

    All sources share ``share`` of the words by weight, none above ``most`` times its own size; what is
    cut off goes to the others by weight, until none is above.
    """
    # One row per source: the only window over all of them.
    place = F.row_number().over(Window.orderBy("none", "name")) - 1
    sources = stored(sources.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long")), "sources")
    up, down = share
    total, all_weight = sources.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # A source is full if its cap is below its share of what the full ones leave.
    left, weight, full = up * total, all_weight, F.lit(False)
    while weight:
        full = F.col("size") * float(most * down * weight) < F.col("weight") * float(left)
        held, of_held = sources.where(full).agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
        now, rest = up * total - most * down * held, all_weight - of_held
        if (now, rest) == (left, weight):
            break
        left, weight = now, rest
    share_of = F.col("weight") * F.lit(left) / F.lit(float(max(1, down * weight)))
    return sources.select("none", "name", "size", F.when(full, (most * F.col("size")).cast("double"))
                          .otherwise(share_of.cast("double")).alias("target"))


def _round(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Pair the fractions ``p`` of rows of ``size`` words until at most one is left."""
    rows = rows.sort_values(["doc_id", "h"], na_position="first", kind="stable").reset_index(drop=True)
    random = np.random.Generator(np.random.PCG64(seed)).random(len(rows)).tolist()
    p, size, open_ = rows["p"].tolist(), rows["size"].tolist(), -1
    for j in range(len(p)):
        if not 0 < p[j] < 1:
            continue
        if open_ < 0:
            open_ = j
            continue
        i = open_
        # Words that can go from j to i, and from i to j.
        to_i, to_j = min((1 - p[i]) * size[i], p[j] * size[j]), min(p[i] * size[i], (1 - p[j]) * size[j])
        if random[j] * (to_i + to_j) < to_j:
            filled, drained = p[i] + to_i / size[i], p[j] - to_i / size[j]
            p[i], p[j] = (1.0, drained) if (1 - p[i]) * size[i] <= p[j] * size[j] else (filled, 0.0)
        else:
            drained, filled = p[i] - to_j / size[i], p[j] + to_j / size[j]
            p[i], p[j] = (0.0, filled) if p[i] * size[i] <= (1 - p[j]) * size[j] else (drained, 1.0)
        for at in (i, j):
            if p[at] < 1e-12 or p[at] > 1 - 1e-12:
                p[at] = float(round(p[at]))
        open_ = next((at for at in (i, j) if 0 < p[at] < 1), -1)
    rows["p"] = p
    return rows


def _drawn(docs: DataFrame, seed: int, group_rows: int, fan_in: int) -> DataFrame:
    """Per distinct id and text: ``doc_id, h, size, source_size, target, rows, copies`` (of all its rows)."""
    rows = docs.select(F.col("doc_id").cast("long"), text_hash().alias("h"), F.col("source").isNull().alias("none"),
                       F.coalesce("source", F.lit("")).alias("name"),
                       F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"))
    sized = stored(rows.groupBy("doc_id", "h", "none", "name", "size").agg(F.count("*").alias("rows")), "sized")
    sums = sized.groupBy("none", "name").agg(F.sum(F.col("size") * F.col("rows")).alias("size"), F.count("*").alias("n"))
    goals = stored(targets(sums.drop("n")).withColumnRenamed("size", "source_size")
                   .join(sums.drop("size"), ["none", "name"]), "targets")
    each = F.when((F.col("size") > 0) & (F.col("source_size") > 0), F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("n") / group_rows)
    part = (sized.join(goals, ["none", "name"]).withColumn("share", F.col("rows") * each)
            .withColumn("copies", F.floor("share")).withColumn("p", F.col("share") - F.floor("share"))
            .withColumn("cell", F.pmod(F.xxhash64("doc_id", "h"), groups)).drop("share", "n"))
    done, part = [part.where("p = 0")], part.where("p > 0")
    cells, level = goals.agg(F.max(groups)).first()[0] or 1, 0

    def rounded(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        words = [seed, level, int(first["cell"]), int(first["none"]), *first["name"].encode()]
        return _round(frame, int(np.random.SeedSequence(words).generate_state(1, np.uint64)[0]))[list(frame.columns)]

    while True:
        part = stored(part.groupBy("none", "name", "cell").applyInPandas(rounded, part.schema), "rounded")
        done.append(part.where("p = 0 OR p = 1"))
        part = part.where("p > 0 AND p < 1")
        if cells <= 1:
            break
        cells, level = -(-cells // fan_in), level + 1
        part = part.withColumn("cell", F.floor(F.col("cell") / fan_in))
    # One fraction a source is left: it is rounded by a number drawn from its row.
    chance = F.pmod(F.xxhash64(F.lit(seed), "none", "name", "doc_id", "h"), F.lit(1 << 40)) / float(1 << 40)
    done.append(part.withColumn("p", (chance < F.col("p")).cast("double")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.withColumn("copies", (F.col("copies") + F.col("p")).cast("long")).drop("p", "cell")


def _own(copies, rows, place):
    """Copies of one of equal rows, shared as evenly as whole numbers allow."""
    return (F.floor(copies / rows) + (place < copies % rows).cast("long")).cast("long")


def mixed(docs: DataFrame, seed: int = 8, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken``, one row per row of ``docs``.

    Size is the number of words (null text: 0); wordless documents and those of wordless sources are
    taken 0 times. Sources are ordered by code point, null last. Each source's taken words differ from
    its target by less than one document; no document is copied more than twice. Groups and random
    numbers depend on the rows alone, so reruns agree. Rows that repeat id, text and source are rounded
    as one and share the copies. Other columns are ignored.
    """
    drawn = _drawn(docs, seed, group_rows, fan_in)
    each = drawn.withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    each = each.withColumn("copies", _own(F.col("copies"), F.col("rows"), F.col("place")))
    return each.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: int = 8, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """The documents, each row as often as `mixed` takes it, with the same columns."""
    key = lambda *of: F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(
        F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), *of)
    drawn = _drawn(docs, seed, group_rows, fan_in).where("copies > 0").select(
        key(F.col("h"), F.col("none"), F.col("name")).alias("key"), "copies", "rows")
    keyed = packed(docs, key=key(text_hash().alias("h"), F.col("source").isNull().alias("none"),
                                 F.coalesce("source", F.lit("")).alias("name")))
    place = F.row_number().over(Window.partitionBy("key").orderBy("key")) - 1
    times = _own(F.col("copies"), F.col("rows"), F.col("place"))
    placed = keyed.join(drawn, "key").withColumn("place", place).withColumn("times", times.cast("int"))
    again = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("again")
    return placed.where("times > 0").select("row", again).select("row.*")
