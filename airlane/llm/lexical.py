"""Ranked lexical search over bags of words, scored once per distinct bag.

Documents are restricted to the vocabulary of the items. What a score depends on is then a document's
vector of term frequencies and its length factor m; documents are sorted by a hash of the two, verified
by comparing them, into classes. A class is scored once against all items, and expanded into its
members by ascending document id. As at most k members of a class can stand among the best k, a task
passes on no more of a class than that before anything is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import prepare, stored, texts_of

#: Documents returned for an item.
K = 50
#: Distinct terms over the items of a slice, each item counting its own; a slice is one pass over the documents.
SLICE_TERMS = 400_000
#: Scores of classes by items that a task holds at a time.
CELLS = 1 << 21
#: Bytes of text whose words are taken at a time.
CHUNK = 1 << 22

_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def bag(text: bytes) -> Counter[bytes]:
    """Terms of a UTF-8 text, A-Z in lower case, with their numbers of occurrences."""
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = cut.start() if cut else len(text)
        found.update(_TERM.findall(text[at:end].lower()))
        at = end
    return found


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, term`` (binary) of ``item_id, text``; rows of one id are one item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [list(bag(t)) for t in texts_of(batch.column("text"))]
            at = pa.array([i for i, terms in enumerate(bags) for _ in terms], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(at),
                                              pa.array([t for terms in bags for t in terms], pa.binary())],
                                             names=["item_id", "term"])

    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, term binary").distinct()


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, bag``: all terms of each document, and its bag over the vocabulary; wordless ones are left out.

    ``bag``: ascending term numbers, then as many frequencies, 4 bytes each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most a slice's terms

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, bags = [], []
            for text in texts_of(batch.column("text")):
                found = bag(text)
                pairs = sorted((known[t], found[t]) for t in known.keys() & found.keys())
                sizes.append(found.total())
                bags.append(np.array(pairs, dtype="<u4").reshape(-1, 2).T.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())],
                                             names=["doc_id", "n", "bag"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(kept, "doc_id long, n long, bag binary").where("n > 0")


def _unpacked(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and frequencies of all bags, one behind the other, and terms per bag."""
    pairs = [np.frombuffer(b.as_py(), dtype="<u4").reshape(2, -1) for b in bags]
    both = np.concatenate(pairs, axis=1).astype(np.int64) if pairs else np.empty((2, 0), dtype=np.int64)
    return both[0], both[1], np.array([p.shape[1] for p in pairs], dtype=np.int64)


def _statistics(bags: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and documents per vocabulary term, over the whole table."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, documents, words = np.zeros(n_terms, dtype=np.int64), 0, 0
        for batch in batches:
            terms, _, _ = _unpacked(batch.column("bag"))
            of += np.bincount(terms, minlength=n_terms)
            documents += batch.num_rows
            words += sum(batch.column("n").to_pylist())
        some = np.flatnonzero(of)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(of[some], [documents, words]))],
                                         names=["term", "n"])

    got = bags.mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    total = dict(zip(got["term"].to_pylist(), got["n"].to_pylist()))  # at most a row per vocabulary term
    return total.get(-1, 0), total.get(-2, 0), np.array([total.get(t, 0) for t in range(n_terms)], dtype=np.int64)


@dataclass(frozen=True)
class Postings:
    """Items of every vocabulary term: those of term t stand at ``item[begin[t]:begin[t + 1]]``."""

    items: int
    begin: np.ndarray
    item: np.ndarray
    weight: np.ndarray

    def scores(self, terms: np.ndarray, tf: np.ndarray, sizes: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whole-number scores, a row per class and a column per item."""
        of = np.repeat(np.arange(len(sizes)), sizes)
        part = self.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
        n = self.begin[terms + 1] - self.begin[terms]
        entry = np.repeat(self.begin[terms] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        cell, value = np.repeat(of, n) * self.items + self.item[entry], np.repeat(part, n)
        # Sums of doubles are exact here: each half is below 2**27, and no item has 2**26 terms.
        add = lambda v: np.bincount(cell, weights=v, minlength=len(sizes) * self.items).astype(np.int64)
        return ((add(value >> 26) << 26) + add(value & ((1 << 26) - 1))).reshape(len(sizes), self.items)


class _Best:
    """The best k classes of each item so far: greatest score, then smallest first member, null last."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.ones(items, dtype=np.int64)
        self.rows = [np.empty((5, 0), dtype=np.int64)]  # item, score, id is null, id, class
        self.held = 0

    def add(self, scores: np.ndarray, none: np.ndarray, first: np.ndarray, classes: np.ndarray) -> None:
        at, item = np.nonzero(scores >= self.floor)
        self.rows.append(np.stack([item, scores[at, item], none[at], first[at], classes[at]]))
        self.held += len(at)
        if self.held > 4 * self.k * len(self.floor):
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.concatenate(self.rows, axis=1)
        rows = rows[:, np.lexsort((rows[4], rows[3], rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        last = rows[:, place == self.k - 1]
        self.floor[last[0]] = last[1]
        rows = rows[:, place < self.k]
        self.rows, self.held = [rows], rows.shape[1]
        return rows


def _slice(docs: DataFrame, pairs: pa.Table, kind: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    ids = pa.compute.unique(pairs["item_id"]) if pairs.num_rows else pairs["item_id"].combine_chunks()
    number = {x: i for i, x in enumerate(ids.to_pylist())}
    terms = sorted(set(pairs["term"].to_pylist()))
    vocabulary = {t: i for i, t in enumerate(terms)}
    bags = stored(restricted(docs, vocabulary), "bags")
    documents, words, df = _statistics(bags, len(terms))

    term = np.array([vocabulary[t] for t in pairs["term"].to_pylist()], dtype=np.int64)
    item = np.array([number[x] for x in pairs["item_id"].to_pylist()], dtype=np.int64)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    postings = Postings(len(number), np.searchsorted(np.sort(term), np.arange(len(terms) + 1)),
                        item[np.argsort(term, kind="stable")], weight)

    m = F.expr(f"50 + CAST(CAST(50 AS DECIMAL(2,0)) * CAST(n AS DECIMAL(18,0)) * {documents} DIV {max(1, words)} AS BIGINT)")
    told = (bags.where("length(bag) > 0").select("doc_id", "bag", m.alias("m"), F.monotonically_increasing_id().alias("row"))
            .withColumn("hash", F.xxhash64("bag", "m")))
    order = Window.partitionBy("hash", "m", "bag").orderBy(F.asc_nulls_last("doc_id"), "row")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    members = (told.withColumn("place", F.row_number().over(order)).withColumn("class", F.first("row").over(so_far))
               .where(F.col("place") <= k))
    one = F.col("place") == 1
    members = stored(members.select("class", "doc_id", "place", F.when(one, F.col("m")).alias("m"),
                                    F.when(one, F.col("bag")).alias("bag")), "classes")
    shared = spark.sparkContext.broadcast(postings)  # at most a slice's pairs

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = shared.value
        best = _Best(postings.items, k)
        rows = max(1, CELLS // max(1, postings.items))
        for batch in batches:
            for begin in range(0, batch.num_rows, rows):
                part = batch.slice(begin, rows)
                whole = lambda name: part.column(name).fill_null(0).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                scores = postings.scores(*_unpacked(part.column("bag")), whole("m"))
                none = part.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                best.add(scores, none, whole("doc_id"), whole("class"))
        got = best.cut()
        first = pa.array(got[3], pa.int64(), mask=got[2].astype(bool))
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(got[0])), pa.array(got[1]), first, pa.array(got[4])],
                                         names=["item_id", "score", "first", "class"])

    reached = members.where(one).select("class", "doc_id", "m", "bag").mapInArrow(
        scored, f"item_id {kind}, score long, first long, class long")
    top = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("first"), "class"))
    classes = reached.withColumn("place", top).where(F.col("place") <= k).select("item_id", "score", "class")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "class", "place"))
    return (classes.join(members.select("class", "doc_id", "place"), "class").withColumn("rank", rank)
            .where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = K, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of each item that score highest, above 0.

    Every row of ``docs`` (``doc_id, text``) is a document of its own, repeated ids and texts included;
    nulls have no terms, a null ``doc_id`` ranks behind all ids of its score. Items without terms have no
    rows; rows of one ``item_id`` (null included) are one item. Items are taken in slices of about
    ``slice_terms`` terms, which bounds what is broadcast. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    pairs = stored(item_terms(items), "item-terms")
    slices = max(1, -(-pairs.count() // slice_terms))
    kind, out = dict(items.dtypes)["item_id"], None
    for part in range(slices):
        of = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == part) if slices > 1 else pairs
        found = _slice(docs, of.toArrow(), kind, k)
        out = found if out is None else out.unionByName(found)
    return out
