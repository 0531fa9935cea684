"""Runs of periodic words by a dictionary of basic factors.

The dictionary numbers, for every power of two, the stretches of that many words: equal stretches of a
text share a number, a stretch that does not recur needs none. The next occurrences of a stretch within
twice its length lie in arithmetic progressions; positions in a row whose next occurrences are equally
far propose that distance as a period. A proposal is extended both ways by comparing numbers from long
stretches to short ones. Several lengths may propose one run: it is kept once, under its least period.

No run is missed: if it has period q, take the power of two l with q <= l < 2q. Inside the run a stretch
of l words recurs first after exactly q words, so at least ``length - l - q + 1`` positions in a row say q.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from airlane.llm.common import prepare, schema_with, texts_of, with_columns

#: Least words of a run and least length of it in periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words of one vectorised pass; a longer text has a pass of its own.
PASS_WORDS = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))


class Factors:
    """The dictionary of basic factors of numbered words; texts stand one behind the other, with no number in common."""

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        """``ends``: for every word, where its text ends."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.following: list[np.ndarray] = []
        at, key = np.arange(len(words)), words
        while True:
            order = np.argsort(key, kind="stable")
            place, sorted_ = at[order], key[order]
            same = sorted_[1:] == sorted_[:-1]
            again = np.zeros(len(at), dtype=bool)
            again[1:] |= same
            again[:-1] |= same
            number = np.empty(len(at), dtype=np.int64)
            number[order] = np.cumsum(np.concatenate([[0], ~same])) if len(at) else 0
            following = np.zeros(len(at), dtype=np.int64)
            following[order[:-1][same]] = (place[1:] - place[:-1])[same]
            recurs = np.zeros(len(at), dtype=bool)
            recurs[order] = again
            at, number, following = at[recurs], number[recurs], following[recurs]
            if not len(at):
                return
            self.levels.append((at, number))
            self.following.append(following)
            # Twice as long: both halves recur, within the text.
            half = 1 << (len(self.levels) - 1)
            second = np.searchsorted(at, at + half)
            pair = (second < len(at)) & (at + 2 * half <= ends[at])
            pair[pair] = at[second[pair]] == at[pair] + half
            key = number[pair] * (int(number.max()) + 1) + number[second[pair]]
            at = at[pair]

    def _same(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the stretches of 2**k words at ``a`` and at ``b`` (none below 0) are equal."""
        at, number = self.levels[k]
        i, j = np.minimum(np.searchsorted(at, a), len(at) - 1), np.minimum(np.searchsorted(at, b), len(at) - 1)
        return (at[i] == a) & (at[j] == b) & (number[i] == number[j])

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the longest stretches of the period around ``at``."""
        # No stretch twice as long as the longest level's recurs, so every level fits at most once.
        up, down = at.copy(), at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            size = 1 << k
            up[self._same(k, up, up + period)] += size
            down[self._same(k, down - size, down - size + period)] -= size
        return down, up - down + period

    def proposals(self, least_words: int, least_periods: int) -> tuple[np.ndarray, np.ndarray]:
        """A position and a period for every row of positions that could belong to a run."""
        places, periods = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for k, ((at, _), following) in enumerate(zip(self.levels, self.following)):
            new = np.ones(len(at), dtype=bool)
            new[1:] = (np.diff(at) != 1) | (np.diff(following) != 0)
            first = np.flatnonzero(new)
            many, q = np.diff(np.append(first, len(at))), following[first]
            needed = np.maximum(least_words, least_periods * q) - (1 << k) - q + 1
            good = (q > 0) & (q <= 2 << k) & (many >= needed)
            places.append(at[first[good]])
            periods.append(q[good])
        return np.concatenate(places), np.concatenate(periods)


def runs_of(words: np.ndarray, sizes: list[int], least_words: int = LEAST_WORDS,
            least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each text, by start and period.

    ``words``: the texts' words as numbers, one text behind the other; ``sizes``: words of each text.
    ``least_periods`` is 3 or more: shorter repetitions need not show.
    """
    if least_periods < 3:
        raise ValueError("a run has at least three periods")
    begins = np.cumsum([0, *sizes])
    text = np.repeat(np.arange(len(sizes)), sizes)
    apart = text * (int(words.max(initial=0)) + 1) + words
    factors = Factors(apart, begins[1:][text])
    at, period = factors.proposals(least_words, least_periods)
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    if not len(at):
        return out
    start, length = factors.extended(at, period)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    keep = length >= np.maximum(least_words, least_periods * period)
    keep[1:] &= (np.diff(start) != 0) | (np.diff(length) != 0)  # a multiple of the period spans the same words
    for s, n, q in zip(start[keep].tolist(), length[keep].tolist(), period[keep].tolist()):
        out[text[s]].append((s - int(begins[text[s]]), n, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those of a run that follow its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _passes(texts: Iterator[bytes]) -> Iterator[list[list[bytes]]]:
    """Words of texts, in groups of about PASS_WORDS."""
    group, size = [], 0
    for text in texts:
        group.append(text.split())
        size += len(group[-1])
        if size >= PASS_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
                  carry: bool = True) -> DataFrame:
    """The documents with ``runs`` (array of ``start, length, period`` in words) and ``collapsed``.

    Words end at ASCII white space. A run is a stretch of at least ``least_words`` words and
    ``least_periods`` of its smallest period that no neighbouring word extends; runs stand by start, then
    period. ``collapsed`` is the text's words, joined by one blank, less what any run holds after its
    first period. A null, empty or blank text has no words: no runs and an empty ``collapsed``. Every
    row is judged for itself, in the task that reads it; the largest text must fit a task. Result columns
    replace columns of their names. ``carry``: keep the text.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = [], []
            for group in _passes(texts_of(batch.column("text"))):
                number: defaultdict[bytes, int] = defaultdict(count().__next__)
                sizes = [len(w) for w in group]
                flat = np.fromiter((number[w] for words in group for w in words), dtype=np.int64, count=sum(sizes))
                for words, of in zip(group, runs_of(flat, sizes, least_words, least_periods)):
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in of])
                    texts.append(collapsed(words, of).decode())
            yield with_columns(batch, ["runs", "collapsed"],
                               [pa.array(runs, _RUNS_ARROW), pa.array(texts, pa.string())], carry)

    prepare(docs.sparkSession)
    return docs.mapInArrow(found, schema_with(docs, f"runs {RUNS}, collapsed string", carry))
