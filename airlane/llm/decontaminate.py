"""Benchmark decontamination as a prefix-filtered set join on word shingles.

A window is 13 consecutive words of an item (a shorter item is one window). All of a window must
stand in the document, so one shingle of it is a sufficient prefix; the rarest one, by its count over
all documents, meets the fewest places. A document place that holds it fixes where the window would
begin (position), which must leave room for all its words (length); the words there are compared.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.llm.common import packed, prepare, schema_with, stored, text_hash, texts_of, with_columns

#: Words of a window and of a prefix shingle.
WINDOW, SHINGLE = 13, 5
#: Most windows, and most bytes of their texts, that are broadcast at a time.
SLICE_ROWS, SLICE_BYTES = 200_000, 32_000_000
#: Texts are joined up to about this many bytes for one vectorised pass.
CHUNK = 1 << 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", dtype=np.uint8)] = True
_IS_WORD[0x80:] = True
_RANDOM = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, size=4096 + WINDOW, dtype=np.uint64)
_BY_PLACE, _BY_WORD = _RANDOM[:4096] * 2 + 1, _RANDOM[4096:] * 2 + 1

RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _hashed(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of lower-cased bytes. Hashes only preselect."""
    hashes, starts, ends = [], [], []
    whole, at = np.frombuffer(joined, dtype=np.uint8), 0
    while at < len(whole):
        upto = min(len(whole), at + 4 * CHUNK)
        while upto < len(whole) and _IS_WORD[whole[upto]]:
            upto += 1  # cut between words
        raw = whole[at:upto]
        edge = np.diff(_IS_WORD[raw].astype(np.int8), prepend=0, append=0)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(s):
            n = e - s
            inside = np.arange(int(n.sum()), dtype=np.int64) - np.repeat(np.cumsum(n) - n, n)
            letters = raw[_IS_WORD[raw]].astype(np.uint64) + np.uint64(1)
            sums = np.add.reduceat(letters * _BY_PLACE[inside & 4095], np.cumsum(n) - n)
            mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            hashes.append(mixed ^ (mixed >> np.uint64(32)))
            starts.append(s + at)
            ends.append(e + at)
        at = upto
    empty = np.empty(0, dtype=np.int64)
    return (np.concatenate(hashes) if hashes else empty.astype(np.uint64),
            np.concatenate(starts) if starts else empty, np.concatenate(ends) if ends else empty)


def _shingled(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out += h[k:k + n] * _BY_WORD[k]
    out ^= out >> np.uint64(31)
    return out * np.uint64(0x94D049BB133111EB)


class _Keys:
    """A sorted set of hashes behind a small table that rules out most others."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.sort(keys)
        self.shift = np.uint64(64 - 22)
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[self.keys >> self.shift] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` of members, and where each stands first in ``keys``."""
        at = np.flatnonzero(self.table[hashes >> self.shift])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        found = np.searchsorted(self.keys, hashes[at])
        same = self.keys[np.minimum(found, len(self.keys) - 1)] == hashes[at]
        return at[same], found[same]


def _passes(column: pa.Array) -> Iterator[list[bytes]]:
    """Lower-cased texts in runs of about CHUNK bytes."""
    run, size = [], 0
    for text in texts_of(column):
        run.append(text.lower())
        size += len(text)
        if size >= CHUNK:
            yield run
            run, size = [], 0
    if run:
        yield run


def _word_table(run: list[bytes]):
    """Joined bytes, word hashes, starts, ends, and the first word of each text (and the end)."""
    joined = b" ".join(run)
    h, starts, ends = _hashed(joined)
    begins = np.cumsum([0, *[len(t) + 1 for t in run]])
    return joined, h, starts, ends, np.searchsorted(starts, begins)


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct ``words, n, item_id``: the windows of all items, space-joined. No words: no window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item_id"), texts_of(batch.column("text"))):
                w = words(text)
                found = [b" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.binary()), pa.array([min(size, len(w))] * len(found), pa.int32()),
                     pa.array([item.as_py()] * len(found), pa.int64())], names=["words", "n", "item_id"])

    return (benchmark.select(F.col("item_id").cast("long"), "text")
            .mapInArrow(cut, "words binary, n int, item_id long").distinct())


def _shingle_keys(rows: pd.DataFrame, shingle: int):
    """Per window its word hashes; per shingle of it: the hash, the window and the offset."""
    hashes = [_hashed(w)[0] for w in rows["words"]]
    keys, of, offsets = [], [], []
    for i, h in enumerate(hashes):
        s = _shingled(h, min(shingle, len(h)))
        keys.append(s)
        of.append(np.full(len(s), i))
        offsets.append(np.arange(len(s)))
    return hashes, np.concatenate(keys), np.concatenate(of), np.concatenate(offsets)


def _corpus_counts(docs: DataFrame, keys: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each shingle hash stands in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, totals = _Keys(shared.value), np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for run in _passes(batch.column("text")):
                # Shingles over the seam of two texts are counted too: order, not results, depends on it.
                _, h, *_ = _word_table(run)
                for size in sizes:
                    _, at = table.places(_shingled(h, size))
                    totals += np.bincount(at, minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["at", "n"])

    rows = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    order = np.sort(keys)
    return {int(order[r["at"]]): r["n"] for r in rows}  # at most one row per benchmark shingle of the slice


def _index(docs: DataFrame, rows: pd.DataFrame, shingle: int) -> dict:
    """What the documents are searched with: each window under its rarest shingle."""
    by_window = rows.groupby("words", sort=True)["item_id"].apply(list)
    texts = pd.DataFrame({"words": list(by_window.index)})
    hashes, keys, of, offsets = _shingle_keys(texts, shingle)
    lengths = np.array([len(h) for h in hashes])
    sizes = sorted({min(shingle, int(n)) for n in lengths})
    counts = _corpus_counts(docs, np.unique(keys), sizes)
    n = np.array([counts.get(int(k), 0) for k in keys])
    order = np.lexsort((offsets, keys, n, of))
    first = order[np.r_[True, of[order][1:] != of[order][:-1]]]
    first = first[np.argsort(keys[first], kind="stable")]
    return {"keys": keys[first], "window": of[first], "offset": offsets[first], "sizes": sizes, "length": lengths,
            "words": list(texts["words"]), "items": [[i for i in x if i == i and i is not None] for x in by_window]}


def _matches(index: dict, table: _Keys, run: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per text: number of words, and starts (in words) and numbers of the windows that stand there."""
    joined, h, starts, ends, firsts = _word_table(run)
    begin, which = [], []
    for size in index["sizes"]:
        at, place = table.places(_shingled(h, size))
        if not len(at):
            continue
        n = np.searchsorted(index["keys"], index["keys"][place], side="right") - place
        at = np.repeat(at, n)
        entry = np.repeat(place, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        window = index["window"][entry]
        start = at - index["offset"][entry]
        text = np.searchsorted(firsts, at, side="right") - 1
        room = (start >= firsts[text]) & (start + index["length"][window] <= firsts[text + 1])
        begin.append(start[room])
        which.append(window[room])
    begin = np.concatenate(begin) if begin else np.empty(0, dtype=np.int64)
    which = np.concatenate(which) if which else np.empty(0, dtype=np.int64)
    same = np.zeros(len(begin), dtype=bool)
    for i, (b, w) in enumerate(zip(begin, which)):
        last = b + index["length"][w] - 1
        span = joined[starts[b]:ends[last]]
        same[i] = span == index["words"][w] or b" ".join(_WORD.findall(span)) == index["words"][w]
    begin, which = begin[same], which[same]
    order = np.argsort(begin, kind="stable")
    begin, which = begin[order], which[order]
    cuts = np.searchsorted(begin, firsts)
    for t in range(len(run)):
        part = slice(cuts[t], cuts[t + 1])
        yield int(firsts[t + 1] - firsts[t]), begin[part] - firsts[t], which[part]


def _spans(begin: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """The union of [begin, begin + length), begins ascending, as disjoint spans."""
    out: list[list[int]] = []
    for b, e in zip(begin.tolist(), (begin + length).tolist()):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [tuple(x) for x in out]


def _digest(n_words: int, spans: list[tuple[int, int]], items: set[int]) -> tuple:
    n_hit = sum(e - b for b, e in spans)
    named = ",".join(sorted(map(str, items)))
    return n_words, n_hit, len(items), hashlib.sha256(named.encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n_words


def _results(rows: list[tuple]) -> list[pa.Array]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    return [pa.array([r[j] for r in rows], t) for j, t in enumerate(types)]


_NAMES = [part.split()[0] for part in RESULT.split(", ")]


def _search(index, batches: Iterator[pa.RecordBatch], finish: bool, carry: bool = False) -> Iterator[pa.RecordBatch]:
    """Batches with the result columns, or with ``n_words, hits, items`` still to be merged."""
    index = index.value
    table = _Keys(index["keys"])
    for batch in batches:
        rows = []
        for run in _passes(batch.column("text")):
            for n, begin, which in _matches(index, table, run):
                spans = _spans(begin, index["length"][which])
                items = {i for w in set(which.tolist()) for i in index["items"][w]}
                rows.append(_digest(n, spans, items) if finish else (n, [x for s in spans for x in s], sorted(items)))
        if finish:
            yield with_columns(batch, _NAMES, _results(rows), carry)
        else:
            lists = pa.list_(pa.int64())
            yield with_columns(batch, ["n_words", "hits", "items"],
                               [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], lists),
                                pa.array([r[2] for r in rows], lists)], carry=False)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Result columns from the hits and items that the slices found."""
    for batch in batches:
        rows = []
        for n, hits, items in zip(*[batch.column(c).to_pylist() for c in ("n_words", "hits", "items")]):
            flat = sorted((h[i], h[i + 1]) for h in hits for i in range(0, len(h), 2))
            begin = np.array([b for b, _ in flat], dtype=np.int64)
            length = np.array([e - b for b, e in flat], dtype=np.int64)
            rows.append(_digest(n, _spans(begin, length), {i for x in items for i in x}))
        yield with_columns(batch.select(["doc_id", "text_hash", "times"]), _NAMES, _results(rows))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  slice_rows: int = SLICE_ROWS, carry: bool = False) -> DataFrame:
    """Which words of each document stand in an occurrence of a benchmark window, and of which items.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, one row per row of
    ``docs``; with ``carry`` all columns of ``docs`` come along (result columns replace columns of the
    same names). Null and wordless texts have no words and are not contaminated. Items with a null id
    make hits but are not named; repeated items count once. The benchmark is cut into slices of
    bounded size, broadcast one at a time; if there are several, their hits merge by document.
    """
    spark: SparkSession = prepare(docs.sparkSession)
    pairs = stored(windows(benchmark, window), "windows")
    n, size = pairs.agg(F.count("*"), F.coalesce(F.sum(F.length("words")), F.lit(0))).first()
    slices = max(1, -(-n // slice_rows), -(-size // SLICE_BYTES))
    slot = F.pmod(F.xxhash64("words", "item_id"), F.lit(slices))
    wanted = docs if carry else docs.select("doc_id", "text")
    if n == 0:
        index = spark.sparkContext.broadcast({
            "keys": np.empty(0, dtype=np.uint64), "window": np.empty(0, dtype=np.int64), "offset": np.empty(0, dtype=np.int64),
            "sizes": [], "length": np.empty(0, dtype=np.int64), "words": [], "items": []})
        return wanted.mapInArrow(partial(_search, index, finish=True, carry=carry), schema_with(wanted, RESULT, carry))
    keyed = docs.select("doc_id", "text", text_hash().alias("text_hash"))
    merged = None
    for k in range(slices):
        part = pairs.where(slot == k).select("words", "item_id").toPandas()  # at most about slice_rows rows
        if not len(part):
            continue
        part["words"] = part["words"].map(bytes)
        part["item_id"] = part["item_id"].astype("Int64").astype(object).where(part["item_id"].notna(), None)
        index = spark.sparkContext.broadcast(_index(docs, part, shingle))
        if slices == 1:
            return wanted.mapInArrow(partial(_search, index, finish=True, carry=carry), schema_with(wanted, RESULT, carry))
        found = keyed.mapInArrow(partial(_search, index, finish=False),
                                 "doc_id long, text_hash long, n_words long, hits array<long>, items array<long>")
        found = stored(found.withColumn("slot", F.lit(k)), "slice-hits")
        merged = found if merged is None else merged.unionByName(found)
    grouped = merged.groupBy("doc_id", "text_hash", "n_words", "slot").agg(
        F.count("*").alias("times"), F.first("hits").alias("hits"), F.first("items").alias("items")).groupBy(
        "doc_id", "text_hash", "n_words").agg(F.max("times").alias("times"), F.collect_list("hits").alias("hits"),
                                              F.collect_list("items").alias("items"))
    results = grouped.mapInArrow(_merged, "doc_id long, text_hash long, times long, " + RESULT)
    if not carry:
        return results.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("again", "times", "text_hash")
    key = lambda h: F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("id"), h.alias("h"))  # noqa: E501, E731
    found = results.select(key(F.col("text_hash")).alias("key"), *_NAMES)
    return packed(docs.drop(*_NAMES), key=key(text_hash())).join(found, "key").select("row.*", *_NAMES)
