"""The toxicity chain against a plain re-computation: features, fit, cut, margins, probabilities."""

import collections
import math
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from airlane.llm import queries, toxicity

SF = "/root/testdata/sf0.001"


def plain_windows(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    n = max(1, math.ceil(len(words) / 200))
    return [words[k * len(words) // n:(k + 1) * len(words) // n] for k in range(n)]


def plain_features(window):
    counts = collections.Counter()
    for w in window:
        counts.update([w[:40], *[w[:k] + "*" for k in (4, 5, 6) if len(w) > k]])
    return {f: math.log1p(c * 200 / max(len(window), 50)) for f, c in counts.items()}


def plain_probabilities(chain, text):
    margins = []
    for window in plain_windows(text):
        values, earlier, row = plain_features(window), [], []
        for w in chain.weights:
            m = sum(v * w[chain.places[f]] for f, v in values.items() if f in chain.places)
            m += sum(p * w[len(chain.places) + j] for j, p in enumerate(earlier)) + w[-1]
            row.append(m)
            earlier.append(1 / (1 + math.exp(-max(-30, min(30, m)))))
        margins.append(row)
    out = []
    for j, cut in enumerate(chain.cuts):
        column = [r[j] for r in margins]
        m = sum(column) / len(column) if cut is None else max(column) - cut
        out.append(1 / (1 + math.exp(-max(-30, min(30, m)))))
    return out


def plain_fit(x, y, penalty=0.5, rounds=150):
    """The same descent over a dense matrix, an intercept last."""
    n, positive = len(y), y.sum()
    each = np.where(y > 0, 0.5 / positive, 0.5 / (n - positive)) * n
    x = np.hstack([x, np.ones((n, 1))])
    v = np.ones(x.shape[1])
    for _ in range(15):
        v = x.T @ (each * (x @ v))
        v /= np.linalg.norm(v)
    curvature = 0.25 * v @ (x.T @ (each * (x @ v))) * 1.1 + penalty
    w = look = np.zeros(x.shape[1])
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ look, -30, 30)))
        new = look - (x.T @ (each * (p - y)) + penalty * np.append(look[:-1], 0)) / curvature
        look, w = new + t / (t + 3) * (new - w), new
    return w


def test_query_equals_plain_probabilities(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    chain = toxicity.train(docs, queries.toxicity_labels(llm.read.parquet(f"{SF}/labels.parquet")), queries.CATEGORIES)
    found = {r["doc_id"]: r for r in queries.op3_toxicity(llm, SF).collect()}
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(found) == len(rows) == 200
    for r in rows:
        expected = plain_probabilities(chain, r["text"] or "")
        assert [found[r["doc_id"]]["p_low_quality"], found[r["doc_id"]]["p_toxic"]] == pytest.approx(expected, abs=1e-6)
        assert found[r["doc_id"]]["toxic"] == (expected[1] > 0.5)


def test_training_equals_a_plain_fit(llm):
    """Labelled rows, features, folds, out-of-fold margins, weights and cuts, all windows of every text."""
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    labels = {r["doc_id"]: (1 - r["quality"], r["toxic"]) for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    docs[-7], labels[-7] = " ".join(docs[d] for d in sorted(docs)[:40]), (0, 0)  # many windows, all of which train
    frame = llm.createDataFrame(list(docs.items()), "doc_id long, text string")
    marks = llm.createDataFrame([(d, *v) for d, v in labels.items()], "doc_id long, low_quality int, toxic int")
    chain = toxicity.train(frame, marks, queries.CATEGORIES, max_features=150)
    rows = [(d, plain_features(w)) for d in sorted(labels) if docs.get(d) is not None for w in plain_windows(docs[d])]
    assert sum(d == -7 for d, _ in rows) > 20
    x = np.array([[f.get(name, 0.0) for name in chain.places] for _, f in rows])
    y = np.array([labels[d] for d, _ in rows], dtype=float)
    folds = np.unique([d for d, _ in rows], return_inverse=True)[1] % toxicity.FOLDS
    presence = collections.Counter(f for _, of in rows for f in of)
    strength = {}
    for j in range(2):
        p, marked = y[:, j].mean(), collections.Counter(f for (_, of), t in zip(rows, y[:, j]) if t for f in of)
        for f, n in presence.items():
            if n >= 3:
                spread = n * p * (1 - p) * (1 - n / (len(rows) + 1))
                strength[f] = max(strength.get(f, 0.0), (marked[f] - n * p) ** 2 / (spread + 1e-9))
    assert set(chain.places) == set(sorted(strength, key=lambda f: (-strength[f], f))[:150])
    earlier = np.zeros((len(rows), 0))
    for j in range(2):
        full, unseen = np.hstack([x, earlier]), np.zeros(len(rows))
        assert chain.weights[j] == pytest.approx(plain_fit(full, y[:, j]), abs=2e-3)
        for fold in range(toxicity.FOLDS):
            w = plain_fit(full[folds != fold], y[folds != fold, j])
            unseen[folds == fold] = full[folds == fold] @ w[:-1] + w[-1]
        cut = toxicity.cut_of(unseen, y[:, j])
        assert chain.cuts[j] == (cut if cut is None else pytest.approx(cut, abs=2e-3))
        earlier = np.hstack([earlier, 1 / (1 + np.exp(-np.clip(unseen[:, None], -30, 30)))])


def test_cut_equals_a_plain_search():
    draw = np.random.Generator(np.random.PCG64(3))
    for _ in range(50):
        y = (draw.random(60) < 0.3).astype(float)
        margins = np.round(draw.normal(size=60) + 2 * y - 1, 1)
        if not 0 < y.sum() < 60:
            continue
        value = {c: np.mean(margins[y > 0] > c) + np.mean(margins[y <= 0] <= c) ** toxicity.LONG_WINDOWS
                 for c in {0.0, *margins[margins > 0]}}
        best = min(c for c in value if value[c] >= max(value.values()) - 1e-12)
        expected = best if np.mean(margins[y > 0] > best) >= 0.5 else None
        assert toxicity.cut_of(margins, y) == expected


def test_repeated_ids_and_window_bound(llm):
    rows = [(1, "bad words here"), (1, "other text"), (2, "fine " * 5000), (3, None), (4, "nice")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    labels = llm.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    one = toxicity.train(docs, labels, ("toxic",))
    two = toxicity.train(docs.repartition(7), labels, ("toxic",))
    assert one.places == two.places and np.array_equal(one.weights[0], two.weights[0])
    assert len(toxicity.train(docs, labels, ("toxic",), max_windows=1).weights) == 1
