"""Token counts of whole texts by a two-tier lookup, without any shuffle of pre-tokens.

A text is cut where white space follows other characters; the byte-level tokenizer never joins bytes
over such a place, so the counts of the pieces add up. A broadcast table, the first tier, holds the
token counts of the pieces that are frequent in all documents; others are counted once per worker and
kept in its bounded cache, the second tier.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlane.llm.common import prepare, schema_with, with_columns

#: Entries of the broadcast table, and the longest piece (in characters) it or a cache keeps.
TABLE_ROWS, PIECE_CHARS = 65_536, 48
#: Pieces a task counts at a time, and how many of its commonest it hands to the aggregation.
COUNTED_ROWS, TOLD_ROWS = 262_144, 32_768
#: Entries of a worker's cache; beyond that it starts again.
CACHE_ROWS = 1_000_000

_PIECE = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: A blank after white space, or white space at an end: such texts are cut by ``_PIECE``, others at blanks.
_UNEVEN = "^[ \t-\r]|[\t-\r ] |[ \t-\r]$"
#: White space beyond ASCII's and controls some call white space: their runs could join over a cut,
#: so the library encodes such texts whole.
_ODD_SPACE = "[\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200d}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{2060}\\x{3000}\\x{feff}]"
#: Bytes of texts that are split at a time; a longer text is split alone.
RUN_BYTES = 4 << 20


def _runs(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts, nulls as empty, in slices of about ``RUN_BYTES``."""
    texts = pc.fill_null(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + RUN_BYTES, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


class PieceCounter:
    """Token counts by one tokenizer file: a fixed ``table`` of frequent pieces, and a ``cache`` of misses."""

    def __init__(self, path: str, table: dict[bytes, int] | None = None, cache_rows: int = CACHE_ROWS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        self.cuts = (made["normalizer"] is None and before.get("type") == "ByteLevel"
                     and before.get("use_regex") and not before.get("add_prefix_space"))
        #: Whether pre-tokens may go straight to the merges.
        self.direct = self.cuts and made["model"].get("type") == "BPE" and not made["model"].get("dropout")
        self.table, self.cache_rows = {k.decode(): n for k, n in (table or {}).items()}, cache_rows
        self.cache: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def count(self, pieces: list[str]) -> list[int]:
        """Token counts of pieces that no tier knows. The library's own cutting comes before its merges."""
        if not self.direct:
            return self.encode(pieces)
        cut, merge, parts, out = self.tokenizer.pre_tokenizer.pre_tokenize_str, self.tokenizer.model.tokenize, self.parts, []
        for piece in pieces:
            n = 0
            for part, _ in cut(piece):
                held = parts.get(part)
                if held is None:
                    held = len(merge(part))
                    if len(part) <= PIECE_CHARS:
                        parts[part] = held
                n += held
            out.append(n)
        if len(parts) > self.cache_rows:
            parts.clear()
        return out

    def lookup(self, pieces: list[str]) -> np.ndarray:
        """Token counts of distinct pieces: from the table, else the cache, else counted and cached."""
        first, second = self.table.get, self.cache.get
        n = np.fromiter((first(p, -1) for p in pieces), dtype=np.int64, count=len(pieces))
        for i in np.flatnonzero(n < 0).tolist():
            n[i] = second(pieces[i], -1)
        new = np.flatnonzero(n < 0).tolist()
        n[new] = self.count([pieces[i] for i in new])
        if len(self.cache) + len(new) > self.cache_rows:
            self.cache.clear()
        self.cache.update((pieces[i], int(n[i])) for i in new if len(pieces[i]) <= PIECE_CHARS)
        return n

    def whole(self, texts: pa.Array) -> np.ndarray:
        """Texts that must be encoded whole."""
        out = np.full(len(texts), not self.cuts)
        if self.cuts:
            out |= pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
            for special in self.specials:
                out |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        return out

    def split(self, texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Pieces of texts that may be cut: distinct ones, their numbers text by text, and pieces per text."""
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        # At a blank that follows no white space a piece begins, and the blank belongs to it.
        lists = pc.split_pattern(texts.filter(pa.array(~uneven)), " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words, of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        heads = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        distinct = [" " + w for w in words]
        other: dict[str, int] = {}
        of[heads] = [len(words) + other.setdefault(words[i], len(other)) for i in of[heads].tolist()]
        numbers, counts = [of], [sizes]
        for text in texts.filter(pa.array(uneven)).to_pylist():
            pieces = _PIECE.findall(text)
            numbers.append(np.array([len(words) + other.setdefault(p, len(other)) for p in pieces], dtype=np.int64))
            counts.append(np.array([len(pieces)], dtype=np.int64))
        order = np.concatenate([np.flatnonzero(~uneven), np.flatnonzero(uneven)])
        return order, distinct + list(other), np.concatenate(numbers), np.concatenate(counts)

    def counted(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Token counts of whole texts."""
        out = [np.zeros(0, dtype=np.int64)]
        for run in _runs(texts):
            n, whole = np.zeros(len(run), dtype=np.int64), self.whole(run)
            n[whole] = self.encode(run.filter(pa.array(whole)).to_pylist())
            order, distinct, of, sizes = self.split(run.filter(pa.array(~whole)))
            sums = np.concatenate([[0], np.cumsum(self.lookup(distinct)[of])])
            ends = np.cumsum(sizes)
            n[np.flatnonzero(~whole)[order]] = sums[ends] - sums[ends - sizes]
            out.append(n)
        return np.concatenate(out)

    def __call__(self, texts: list[bytes]) -> list[int]:
        return self.counted(pa.array([t.decode() for t in texts], pa.string())).tolist()


_worker: dict[tuple[str, str], PieceCounter] = {}


def worker_counter(tokenizer: str, key: str, table: Broadcast | None = None) -> PieceCounter:
    """The worker's counter for one call, told apart by ``key``; its tasks share tokenizer, table and cache."""
    if (tokenizer, key) not in _worker:
        _worker.clear()
        _worker[tokenizer, key] = PieceCounter(tokenizer, table.value if table else None)
    return _worker[tokenizer, key]


def commonest(counts: Iterator[tuple[list[str], np.ndarray]], rows: int = COUNTED_ROWS, told: int = TOLD_ROWS) -> list[tuple[str, int]]:
    """The pieces that occur most, of distinct pieces and their occurrences, with about how often.

    Holds ``rows`` pieces and those of one run of texts at most: when there are more, those above the middle count stay.
    """
    seen: Counter[str] = Counter()
    for pieces, occurrences in counts:
        seen.update(dict(zip(pieces, occurrences.tolist())))
        if len(seen) > rows:
            middle = np.median(np.fromiter(seen.values(), dtype=np.int64, count=len(seen)))
            seen = Counter({p: n for p, n in seen.items() if n > middle})
    return [(p, n) for p, n in seen.most_common(told) if n and len(p) <= PIECE_CHARS]


def frequent_pieces(docs: DataFrame, tokenizer: str, entries: int = TABLE_ROWS) -> dict[bytes, int]:
    """Token counts of the commonest pieces of all texts; what it holds changes speed, not results.

    Every task counts its pieces within bounds and hands on its commonest; these are added up by
    aggregation. Eighth powers of two part the sums into at most 512 levels, and the highest whole
    levels of together at most ``entries`` pieces of bounded length come to the driver.
    """

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(tokenizer, "pieces")

        def occurrences():
            for batch in batches:
                for run in _runs(batch.column("text")):
                    _, distinct, of, _ = counter.split(run.filter(pa.array(~counter.whole(run))))
                    yield distinct, np.bincount(of, minlength=len(distinct))

        best = commonest(occurrences())
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
                                         names=["piece", "n"])

    counted = docs.select("text").where("text IS NOT NULL").mapInArrow(told, "piece string, n long")
    summed = counted.groupBy("piece").agg(F.sum("n").alias("n"))
    summed = summed.withColumn("level", F.floor(8 * F.log2("n"))).persist()
    try:
        held, least = 0, None
        for level, size in sorted(summed.groupBy("level").count().collect(), reverse=True):
            if (held := held + size) > entries:
                break
            least = level
        pieces = [] if least is None else [r.piece for r in summed.where(F.col("level") >= least).select("piece").collect()]
    finally:
        summed.unpersist()
    return dict(zip([p.encode() for p in pieces], PieceCounter(tokenizer).count(pieces)))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, carry: bool = True) -> DataFrame:
    """The documents with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``tokenizer`` is a file of the tokenizers library that every worker can read. Whole texts count,
    as the library's ``encode`` gives them without added special tokens; its special strings inside a
    text are one token each. A null text counts as empty. Result columns replace columns of their
    names; every row counts for itself. ``carry``: keep the text.
    """
    prepare(docs.sparkSession)
    table, key = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, tokenizer)), uuid.uuid4().hex

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(tokenizer, key, table)
        for batch in batches:
            texts = batch.column("text")
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            n = counter.counted(texts)
            yield with_columns(batch, ["n_bytes", "n_tokens", "over_limit"],
                               [size, pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], carry)

    return docs.mapInArrow(counted, schema_with(docs, "n_bytes long, n_tokens long, over_limit boolean", carry))
