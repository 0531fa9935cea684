"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is its words, maximal runs of letters in lower case, each framed by blanks; its features are the
1-, 2- and 3-grams inside the framed words, hashed into buckets. A model is one matrix of log
probabilities, a row per bucket and a column per language, as whole numbers of ``1 / SCALE``: sums over
a text are exact, whatever batch it stands in. A batch of texts is a sparse matrix in row-pointer form,
and its scores are the gathered rows of the model, summed by segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlane.llm.common import prepare, schema_with, stored, texts_of, with_columns

#: Buckets as a power of two, added count of every bucket, unit of the log probabilities.
BITS, SMOOTHING, SCALE = 15, 0.5, 1 << 16
#: Most languages of a model; they bound its matrix to 64 MB.
MOST_LANGUAGES = 512
#: Characters of one vectorised pass, and of the pieces that a longer text is cut into.
CHUNK = 1 << 18
#: Of a text that is null, has no letter, or meets a model without languages.
UNDETERMINED = "und"

_BLANK = 32
_MULTIPLIERS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, size=7, dtype=np.uint64) * 2 + 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.strings.isalpha(np.arange(0x110000, dtype="<u4").view("<U1"))


def _bucket(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    return ((h * _MULTIPLIERS[6]) >> np.uint64(64 - BITS)).astype(np.int64)


def _pieces(text: str) -> Iterator[str]:
    """A long text in pieces, cut before a character that is no letter, within a word only if it is as long."""
    at = 0
    while len(text) - at > CHUNK:
        end = at + CHUNK
        while end > at and text[end].isalpha():
            end -= 1
        end = end if end > at else at + CHUNK
        yield text[at:end]
        at = end
    yield text[at:]


def _passes(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Pieces of about CHUNK characters together, and the text that each belongs to."""
    pieces, of, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            if pieces and size + len(piece) > CHUNK:
                yield pieces, of
                pieces, of, size = [], [], 0
            pieces.append(piece)
            of.append(i)
            size += len(piece)
    if pieces:
        yield pieces, of


def _framed(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of `` word word `` per piece, joined, and where each piece begins and, last, all end."""
    low = [f" {p.lower()} " for p in pieces]
    begins = np.cumsum([0, *map(len, low)])
    codes = np.frombuffer("".join(low).encode("utf-32-le"), dtype="<u4")
    letter = _letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[begins[:-1]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, codes, _BLANK)[keep].astype(np.uint64), kept[begins]


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the texts' n-grams and the text of each, in passes of bounded size."""
    m = _MULTIPLIERS
    for pieces, of in _passes(texts):
        codes, begins = _framed(pieces)
        text = np.repeat(np.array(of), np.diff(begins))
        letter = codes != _BLANK
        one = np.flatnonzero(letter)
        two = np.flatnonzero(letter[1:] | letter[:-1])
        three = np.flatnonzero(letter[1:-1])
        c = codes
        for first, hashes in ((one, c[one] * m[0]),
                              (two, c[two] * m[1] + c[two + 1] * m[2]),
                              (three, c[three] * m[3] + c[three + 1] * m[4] + c[three + 2] * m[5])):
            yield _bucket(hashes), text[first]


@dataclass(frozen=True)
class Model:
    """Languages in code point order, log probability per bucket and language, log share of documents."""

    languages: tuple[str, ...]
    matrix: np.ndarray
    prior: np.ndarray

    def margins(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scaled log scores, a row per text, and whether it has a letter."""
        scores = np.tile(self.prior, (len(texts), 1))
        told = np.zeros(len(texts), dtype=bool)
        for buckets, of in grams(texts):
            if len(of):
                begins = np.flatnonzero(np.diff(of, prepend=-1))
                scores[of[begins]] += np.add.reduceat(self.matrix[buckets], begins, axis=0, dtype=np.int64)
                told[of[begins]] = True
        return scores, told

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text (ties: first by code point) and its probability."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        scores, told = self.margins(texts)
        best = scores.argmax(axis=1) if len(texts) else np.empty(0, dtype=np.int64)
        below = (scores - scores.max(axis=1, keepdims=True)) / SCALE
        p = np.where(told, 1 / np.exp(below).sum(axis=1), 0.0)
        return [self.languages[b] if t else UNDETERMINED for b, t in zip(best, told)], p


def train(docs: DataFrame) -> Model:
    """A model of all rows of ``text, lang`` where neither is null.

    Every task counts its rows into one matrix and sends the counts that are not zero; they are added by
    language and bucket. Repeated rows count each time; a text without letters only counts as a document.
    No rows give a model without languages; more than ``MOST_LANGUAGES`` raise. Other columns are ignored.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts = [t.decode() for t in texts_of(batch.column("text"))]
            langs = batch.column("lang").to_pylist()
            for lang in langs:
                sums.setdefault(lang, np.zeros((1 << BITS) + 1, dtype=np.int64))[-1] += 1
            names = list(sums)
            at = np.array([names.index(lang) for lang in langs], dtype=np.int64)
            for buckets, of in grams(texts):
                total = np.bincount(at[of] * (1 << BITS) + buckets, minlength=len(names) << BITS)
                for lang, row in zip(names, total.reshape(len(names), -1)):
                    sums[lang][:-1] += row
        for lang, row in sums.items():
            found = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.int32()),
                                              pa.array(row[found], pa.int64())], names=["lang", "bucket", "n"])

    prepare(docs.sparkSession)
    known = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = stored(known.mapInArrow(counted, "lang string, bucket int, n long")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngram-counts")
    languages = sorted(r.lang for r in counts.where(F.col("bucket") == 1 << BITS).select("lang")
                       .limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = counts.toArrow()  # a row per language and bucket at most
    row = np.searchsorted(np.array(languages, dtype=object), np.array(found["lang"].to_pylist(), dtype=object))
    dense = np.zeros((len(languages), (1 << BITS) + 1))
    dense[row, found["bucket"].to_numpy()] = found["n"].to_numpy()
    documents, of_bucket = dense[:, -1], dense[:, :-1] + SMOOTHING
    log_p = np.log(of_bucket) - np.log(of_bucket.sum(axis=1, keepdims=True))
    prior = np.log(np.maximum(documents, 1)) - np.log(max(documents.sum(), 1))
    whole = lambda x: np.rint(x * SCALE)
    return Model(tuple(languages), np.ascontiguousarray(whole(log_p).T.astype(np.int32)), whole(prior).astype(np.int64))


def identify(docs: DataFrame, model: Model, carry: bool = True) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, the probability of that language by the model.

    Whole texts count, and nothing but the text. A null, empty or letterless text is ``und`` with score
    0. Every row is judged for itself; result columns replace columns of their names. ``carry``: keep the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_LANGUAGES

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, p = shared.value.predict([t.decode() for t in texts_of(batch.column("text"))])
            yield with_columns(batch, ["lang_pred", "score"], [pa.array(langs, pa.string()), pa.array(p, pa.float64())], carry)

    prepare(docs.sparkSession)
    return docs.mapInArrow(judged, schema_with(docs, "lang_pred string, score double", carry))
