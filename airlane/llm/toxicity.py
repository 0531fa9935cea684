"""Classifier chain for toxicity categories.

The categories are predicted one after another by logistic models over word features; every later
model also sees the probabilities of the earlier categories. It is trained on out-of-fold
predictions, so that it learns how far an earlier model can be trusted on texts it has not seen.

Texts are cut into consecutive windows of about equal numbers of words, in training and in scoring. A
feature's value is its density in the window, and the window of the largest margin decides for the whole
text, so that neither chance words of a long text add up nor a passage of it is diluted. As a long text
has many windows to be wrong about, a margin counts from a cut that out-of-fold windows set. A category
that single windows do not show that well is one of whole texts: the mean margin of all windows decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlane.llm.common import prepare, schema_with, text_hash, texts_of, with_columns

#: Bounds of the training: labelled rows, their windows together, word features; folds.
MAX_ROWS, MAX_WINDOWS, MAX_FEATURES, FOLDS = 6_000, 30_000, 2_000, 4
#: Beginnings of words that are features besides the whole words, in characters.
STEMS = (4, 5, 6)
#: Most words of a window, least words its densities refer to, characters of a word that count.
WINDOW, LEAST_WORDS, LONGEST = 200, 50, 40
#: Windows of the long texts for which the cut is set.
LONG_WINDOWS = 100
#: Words whose places a worker remembers; beyond that it starts again.
CACHE_ROWS = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def _features(word: str) -> list[str]:
    """The word and, marked by ``*``, its beginnings; of a longer word, the first LONGEST characters count."""
    return [word[:LONGEST], *[word[:n] + "*" for n in STEMS if len(word) > n]]


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _bounds(n_words: int) -> np.ndarray:
    """Where the windows of a text begin and, last, where it ends; a text without words has one empty window."""
    n = max(1, -(-n_words // WINDOW))
    return np.arange(n + 1) * n_words // n


def _density(counts: np.ndarray, n_words: np.ndarray | int) -> np.ndarray:
    """Feature values from counts in windows of ``n_words`` words."""
    return np.log1p(counts * (WINDOW / np.maximum(n_words, LEAST_WORDS)))


def _trained(text: str) -> list[dict[str, list]]:
    """Features and values of every window of the text."""
    words, out = _words(text), []
    bounds = _bounds(len(words))
    for begin, end in zip(bounds[:-1], bounds[1:]):
        part = words[begin:end]
        counts = sorted(Counter(f for w in part for f in _features(w)).items())
        values = _density(np.array([c for _, c in counts], dtype=np.float64), len(part))
        out.append({"features": [f for f, _ in counts], "density": values.tolist()})
    return out


@dataclass(frozen=True)
class Windows:
    """Features of windows as flat arrays: window k holds the entries ``begin[k]`` to ``begin[k + 1]``."""

    begin: np.ndarray
    place: np.ndarray
    value: np.ndarray
    width: int

    @property
    def n(self) -> int:
        return len(self.begin) - 1

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.begin))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """A sum per window of its values times the weights of their places."""
        return np.bincount(self.row, weights=self.value * weights[self.place], minlength=self.n)

    def against(self, rows: np.ndarray) -> np.ndarray:
        """A sum per place of its values times the numbers of their windows."""
        return np.bincount(self.place, weights=self.value * rows[self.row], minlength=self.width)


def _logistic(x: Windows, earlier: np.ndarray, y: np.ndarray, used: np.ndarray, penalty: float = 0.5, rounds: int = 150) -> np.ndarray:
    """Weights of the places, of the columns ``earlier`` and, last, the intercept, fitted on the rows ``used``.

    Both classes weigh alike. Accelerated gradient descent; rows left out weigh nothing.
    """
    n, positive, width = int(used.sum()), float(y[used].sum()), x.width + earlier.shape[1] + 1
    if positive in (0.0, float(n)):
        return np.append(np.zeros(width - 1), 30.0 if positive else -30.0)
    each = np.where(y > 0, 0.5 / positive, 0.5 / (n - positive)) * n * used
    times = lambda w: x.times(w[:x.width]) + earlier @ w[x.width:-1] + w[-1]
    against = lambda r: np.concatenate([x.against(r), earlier.T @ r, [r.sum()]])
    # Largest curvature by a few power steps.
    v = np.ones(width)
    for _ in range(15):
        v = against(each * times(v))
        v /= np.linalg.norm(v)
    curvature = 0.25 * float(v @ against(each * times(v))) * 1.1 + penalty
    w = look = np.zeros(width)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(times(look), -30, 30)))
        slope = against(each * (p - y)) + penalty * np.append(look[:-1], 0.0)
        new = look - slope / curvature
        look, w = new + t / (t + 3) * (new - w), new
    return w


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


class _Places(dict):
    """Places of a word's features, remembered."""

    def __init__(self, places: dict[str, int]) -> None:
        super().__init__()
        self.places = places

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self[word] = tuple(p for f in _features(word) if (p := self.places.get(f)) is not None)
        return found


@dataclass(frozen=True)
class Chain:
    """The features' places and, per category, weights over them and over the earlier categories, and the cut."""

    categories: tuple[str, ...]
    places: dict[str, int]
    weights: tuple[np.ndarray, ...]
    cuts: tuple[float | None, ...]

    def margins(self, text: str, known: _Places) -> np.ndarray:
        """A row per window of the text, a column per category; cuts are not taken off."""
        words, n_places = _words(text), max(1, len(self.places))
        bounds = _bounds(len(words))
        at = [known[w] for w in words]
        per_word = np.fromiter(map(len, at), dtype=np.int64, count=len(at))
        sizes = np.diff(bounds)
        of = np.repeat(np.repeat(np.arange(len(sizes)), sizes), per_word)
        flat = np.fromiter((p for places in at for p in places), dtype=np.int64, count=len(of))
        keys, counts = np.unique(of * n_places + flat, return_counts=True)
        of, place = keys // n_places, keys % n_places
        values = _density(counts, sizes[of])
        out, earlier = np.zeros((len(sizes), len(self.categories))), np.zeros((len(sizes), len(self.categories)))
        for j, w in enumerate(self.weights):
            out[:, j] = (np.bincount(of, weights=values * w[place], minlength=len(sizes))
                         + earlier[:, :j] @ w[len(self.places):-1] + w[-1])
            earlier[:, j] = _probability(out[:, j])
        return out

    def probabilities(self, texts: list[str], known: _Places | None = None) -> np.ndarray:
        """A row per text: probabilities at its windows' largest margin less the cut, or, without one, at their mean."""
        known = _Places(self.places) if known is None else known
        out = np.zeros((len(texts), len(self.categories)))
        for i, text in enumerate(texts):
            margins = self.margins(text, known)
            out[i] = _probability(np.array([margins[:, j].mean() if cut is None else margins[:, j].max() - cut
                                            for j, cut in enumerate(self.cuts)]))
            if len(known) > CACHE_ROWS:
                known.clear()
        return out


def fit_chain(x: Windows, labels: np.ndarray, folds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """One weight vector per label column, in order, and out-of-fold margins; see the module's text."""
    earlier = np.zeros((x.n, 0))
    out, unseen = [], np.zeros(labels.shape)
    for j in range(labels.shape[1]):
        y = labels[:, j]
        out.append(_logistic(x, earlier, y, np.ones(x.n, dtype=bool)))
        for fold in np.unique(folds):
            held = folds == fold
            w = _logistic(x, earlier, y, ~held)
            unseen[held, j] = (x.times(w[:x.width]) + earlier @ w[x.width:-1] + w[-1])[held]
        earlier = np.hstack([earlier, _probability(unseen[:, j:j + 1])])
    return out, unseen


def cut_of(margins: np.ndarray, y: np.ndarray, n_windows: int = LONG_WINDOWS) -> float | None:
    """The margin, 0 or more, above which a window speaks for its text.

    It makes the share of positive windows above it, plus the share of texts of ``n_windows`` negative
    windows with none above it, largest; of equal cuts, the smallest. None if it passes less than half of
    the positive windows. Margins are out-of-fold.
    """
    positive, negative = np.sort(margins[y > 0]), np.sort(margins[y <= 0])
    if not len(positive) or not len(negative):
        return None
    cuts = np.unique(np.append(margins[margins > 0], 0.0))
    found = 1 - np.searchsorted(positive, cuts, side="right") / len(positive)
    clean = (np.searchsorted(negative, cuts, side="right") / len(negative)) ** n_windows
    best = np.argmax(found + clean)
    return float(cuts[best]) if found[best] >= 0.5 else None


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], max_rows: int = MAX_ROWS,
          max_features: int = MAX_FEATURES, n_folds: int = FOLDS, max_windows: int = MAX_WINDOWS) -> Chain:
    """Fit the chain on at most ``max_rows`` labelled documents, those whose ids hash lowest.

    Of these, in the same order, whole documents up to ``max_windows`` windows together, one at least;
    both bound what the driver holds. ``labels``: ``doc_id`` and a 0/1 column per category; rows with a
    null in one of these take no part, nor do null texts; of an id labelled twice, the largest label of
    each category holds; of an id with several texts, that of the smallest hash. The windows of a
    document bear its labels; folds keep them together. Word features are the ``max_features`` whose
    presence in windows differs most (chi-square) for some category.
    Without labelled rows, every probability is near 0.
    """
    names = [f"label_{j}" for j in range(len(categories))]
    chosen = (labels.select("doc_id", *[F.col(c).cast("double").alias(n) for c, n in zip(categories, names)])
              .dropna().groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = (docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
              .groupBy("doc_id").agg(F.min_by(F.struct("text", *names), text_hash()).alias("of")).select("doc_id", "of.*"))

    window = pa.struct([("features", pa.list_(pa.string())), ("density", pa.list_(pa.float32()))])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_trained(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[batch.column(c) for c in names], pa.array(rows, pa.list_(window))],
                names=["doc_id", *names, "windows"])

    prepare(docs.sparkSession)
    marked = "doc_id long, " + ", ".join(f"{c} double" for c in names)
    rows = sample.mapInArrow(present, marked + ", windows array<struct<features: array<string>, density: array<float>>>").persist()
    try:
        upto = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # of at most max_rows narrow rows
        within = (rows.select("doc_id", F.size("windows").alias("n")).withColumn("upto", upto)
                  .where((F.col("upto") <= max_windows) | (F.col("upto") == F.col("n"))).select("doc_id"))
        cut = rows.join(F.broadcast(within), "doc_id").select("doc_id", *names, F.posexplode("windows").alias("window", "of")).select(
            "doc_id", *names, "window", "of.features", "of.density")
        totals = cut.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
        n = totals["n"]
        counts = (cut.select(F.explode("features").alias("feature"), *names).groupBy("feature")
                  .agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names]).where("n >= 3"))
        strength = F.lit(0.0)
        for c in names:
            p = (totals[c] or 0.0) / max(n, 1)
            spread = F.col("n") * p * (1 - p) * (1 - F.col("n") / (n + 1))
            strength = F.greatest(strength, F.pow(F.col(c) - F.col("n") * p, 2) / (spread + 1e-9))
        best = counts.orderBy(F.desc(strength), "feature").limit(max_features).select("feature").collect()
        places = {r.feature: i for i, r in enumerate(best)}
        shared = docs.sparkSession.sparkContext.broadcast(places)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = shared.value
            for batch in batches:
                pairs = [[(table[f], v) for f, v in zip(fs.as_py(), vs.as_py()) if f in table]
                         for fs, vs in zip(batch.column("features"), batch.column("density"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[batch.column(c) for c in names], batch.column("window"),
                     pa.array([[p for p, _ in row] for row in pairs], pa.list_(pa.int32())),
                     pa.array([[v for _, v in row] for row in pairs], pa.list_(pa.float32()))],
                    names=["doc_id", *names, "window", "at", "density"])

        # At most max_windows rows, with a place and a value per feature met, as Arrow buffers.
        known = cut.mapInArrow(placed, marked + ", window int, at array<int>, density array<float>").toArrow()
    finally:
        rows.unpersist()
    if not known.num_rows:
        return Chain(categories, places, tuple(np.append(np.zeros(j), -30.0) for j in range(len(names))), (None,) * len(names))
    known = known.take(pc.sort_indices(known.select(["doc_id", "window"]), [("doc_id", "ascending"), ("window", "ascending")]))
    at, density = known["at"].combine_chunks(), known["density"].combine_chunks()
    x = Windows(np.concatenate([[0], np.cumsum(pc.list_value_length(at).to_numpy())]), at.flatten().to_numpy(),
                density.flatten().to_numpy(), len(places))
    y = np.stack([known[c].to_numpy() for c in names], axis=1)
    folds = np.unique(known["doc_id"].to_numpy(), return_inverse=True)[1] % max(2, n_folds)
    del known, at, density
    weights, unseen = fit_chain(x, y, folds)
    return Chain(categories, places, tuple(weights), tuple(cut_of(unseen[:, j], y[:, j]) for j in range(len(names))))


def score(docs: DataFrame, chain: Chain, prefix: str = "p_", carry: bool = True) -> DataFrame:
    """The documents with a probability ``p_<category>`` for each category; a null text counts as empty.

    Every row is scored for itself; result columns replace columns of their names. ``carry``: keep the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [prefix + c for c in chain.categories]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = _Places(model.places)
        for batch in batches:
            p = model.probabilities([t.decode() for t in texts_of(batch.column("text"))], known)
            yield with_columns(batch, names, [pa.array(p[:, j]) for j in range(len(names))], carry)

    prepare(docs.sparkSession)
    return docs.mapInArrow(scored, schema_with(docs, ", ".join(f"{n} double" for n in names), carry))
