"""Language identification, lexical search and periodic runs: brute force, held-out rows, odd input."""

import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from airlane.llm import LLM_QUERIES, langid, lexical, periodic
from airlane.llm.queries import with_planted_runs

SF = "/root/testdata/sf0.001"
LONG = "word and more of it, " * 40_000


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


# -- language ----------------------------------------------------------------------------------------


def brute_grams(text):
    """N-grams of the framed words, counted in plain Python."""
    words = re.findall(r"\S+", "".join(c if c.isalpha() else " " for c in text.lower()))
    found = collections.Counter()
    for w in words:
        framed = f" {w} "
        found.update(w)
        found.update(framed[i:i + 2] for i in range(len(framed) - 1))
        found.update(framed[i:i + 3] for i in range(len(framed) - 2))
    return found


def bucket(gram):
    """The bucket of one n-gram by the module's own hash."""
    m, c = langid._MULTIPLIERS, np.array([[ord(x)] for x in gram], dtype=np.uint64)
    of = {1: (0,), 2: (1, 2), 3: (3, 4, 5)}[len(gram)]
    return int(langid._bucket(sum(c[i] * m[k] for i, k in enumerate(of)))[0])


def test_grams_equal_brute_force(monkeypatch):
    texts = ["", "Ab c", "x", "...", "Ünï-çödé 12ab  ", "a b\x01c", "日本語 テスト", "İstanbul", "ab" * 50 + " c " * 40]
    for chunk in (langid.CHUNK, 16):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        found = collections.defaultdict(collections.Counter)
        for buckets, of in langid.grams(texts):
            for b, i in zip(buckets.tolist(), of.tolist()):
                found[i][b] += 1
        for i, text in enumerate(texts[:-1] if chunk == 16 else texts):  # a word longer than a piece is cut
            expected = collections.Counter()
            for gram, n in brute_grams(text).items():
                expected[bucket(gram)] += n
            assert found[i] == expected, (chunk, text)


def test_language_id_equals_brute_force(llm, documents):
    counts, of = collections.defaultdict(collections.Counter), collections.Counter()
    for r in documents:
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["text"] is not None and r["lang"] is not None:
            of[r["lang"]] += 1
            for gram, n in brute_grams(r["text"]).items():
                counts[r["lang"]][gram] += n
    sums = {lang: collections.Counter() for lang in counts}
    for lang, grams in counts.items():
        for gram, n in grams.items():
            sums[lang][bucket(gram)] += n
    total = {lang: sum(c.values()) + langid.SMOOTHING * (1 << langid.BITS) for lang, c in sums.items()}
    found = {r["doc_id"]: r for r in LLM_QUERIES["op11_language_id"](llm, SF).collect()}
    assert len(found) == len(documents)
    right = tried = 0
    for r in documents:
        grams = brute_grams(r["text"] or "")
        margin = {lang: math.log(of[lang] / sum(of.values())) + sum(
            n * math.log((sums[lang][bucket(g)] + langid.SMOOTHING) / total[lang]) for g, n in grams.items()) for lang in sums}
        best = max(sorted(margin), key=margin.get)
        got = found[r["doc_id"]]
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert got["lang_pred"] == (best if grams else "und")
        if grams:
            assert got["score"] == pytest.approx(1 / sum(math.exp(m - margin[best]) for m in margin.values()), abs=0.01)
        if got["held_out"] and grams:
            tried += 1
            right += got["lang_pred"] == r["lang"]
    assert tried > 20 and right >= 0.97 * tried


def test_language_id_on_held_out_rows(llm):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    held = [r for r in LLM_QUERIES["op11_language_id"](llm, sf).collect() if r["held_out"]]
    right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in held)
    print("held out, right:", len(held), right)
    assert len(held) > 150 and right >= 0.98 * len(held)


def test_language_id_edges(llm):
    rows = [(1, "the cat and the dog", "en", "x"), (1, "the cat and the dog", "en", "x"), (2, "der hund und die katze", "de", "x"),
            (3, None, "en", "x"), (4, "", "de", None), (5, "123 ... 45", "de", "x"), (None, "und der hund", None, "x"),
            (7, LONG, "en", "x"), (8, "more", "en", "x")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string").withColumn("score", F.lit("old"))
    model = langid.train(docs)
    assert model.languages == ("de", "en")
    found = langid.identify(docs, model).orderBy(F.asc_nulls_last("doc_id")).collect()
    assert set(found[0].asDict()) == {"doc_id", "text", "lang", "lang_pred", "score"}
    # Ids ascend, the null id stands last.
    assert [r["lang_pred"] for r in found] == ["en", "en", "de", "und", "und", "und", "en", "en", "de"]
    assert found[0] == found[1] and found[3]["score"] == 0.0 and all(0 <= r["score"] <= 1 for r in found)
    none = langid.train(docs.where("false"))
    assert none.languages == ()
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, none).collect()} == {("und", 0.0)}
    assert langid.identify(docs.where("false"), model).count() == 0


# -- lexical search ----------------------------------------------------------------------------------


def brute_search(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(d, collections.Counter(cut(t))) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    terms = collections.defaultdict(set)
    for item, text in items:
        terms[item] |= set(cut(text))
    out = []
    for item, of in terms.items():
        scores = []
        for d, b in bags:
            m = 50 + (50 * b.total() * n_docs) // n_terms if b else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in of if b[t])
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_terms", [lexical.SLICE_TERMS, 3])
def test_search_edges(llm, monkeypatch, slice_terms):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "Ab", "x-y"]
    docs = [(i, " ".join(random.choices(vocabulary, k=random.randrange(1, 12)))) for i in range(200)]
    docs += [(300 + i, "w1 w2 w2 é") for i in range(90)]  # one class of many members
    docs += [(400, None), (401, ""), (402, " .,; "), (403, LONG), (None, "w1 w2 w2 é"), (300, "w1 w2 w2 é"), (5, "w3 w3")]
    items = [(1, "w1 w2 zz"), (2, "É ab AB"), (3, None), (4, ""), (5, "w3"), (5, "W4 w3"), (None, "w5"), (7, "absent"), (8, "word w1")]
    monkeypatch.setattr(lexical, "CELLS", 64)
    monkeypatch.setattr(lexical, "CHUNK", 1000)
    frame = (llm.createDataFrame(docs, "doc_id long, text string").repartition(5)
             .withColumns({c: F.lit("x") for c in ("n", "bag", "class", "place", "rank", "score", "item_id", "row", "hash", "m")}))
    asked = llm.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    found = sorted(map(tuple, lexical.search(frame, asked, 20, slice_terms).collect()), key=repr)
    assert found == brute_search(docs, items, 20)


def test_search_of_empty_tables(llm):
    none = llm.createDataFrame([], "doc_id long, text string")
    items = llm.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, items).collect() == []
    some = llm.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical.search(some, items.where("false")).collect() == []
    assert len(lexical.search(some, items).collect()) == 1


def test_scores_are_exact_whole_numbers():
    random.seed(1)
    of = [sorted(random.sample(range(3), random.randrange(1, 4))) for _ in range(40)]
    begin = np.cumsum([0, *map(len, of)])
    weight = np.array([random.randrange(60_000) for _ in of])
    postings = lexical.Postings(3, begin, np.array([i for x in of for i in x]), weight)
    terms, tf = np.arange(40), np.array([random.choice([1, 2, 50, 2**31]) for _ in of])
    got = postings.scores(terms, tf, np.array([40]), np.array([77]))
    for i in range(3):
        assert got[0, i] == sum(int(weight[t]) * ((10**9 * int(tf[t])) // (1000 * int(tf[t]) + 20 * 77)) for t in range(40) if i in of[t])


# -- periodic runs -----------------------------------------------------------------------------------


def brute_runs(words, least_words=24, times=3):
    n, spans = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_words, times * q):
                spans.setdefault((i, length), q)  # periods ascend: the smallest stays
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in spans.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    random.seed(11)
    texts = [[], ["a"] * 23, ["a"] * 24, ["a"] * 100, list("ab") * 12, list("aab") * 10, ["x", *list("ab") * 30, "a", "y"],
             (list("aab") * 9 + ["c"]) * 4, list("abcdefgh") * 3, list("abcdefgh") * 2 + list("abcdefg")]
    for _ in range(300):
        text = []
        while len(text) < random.randrange(10, 260):
            block = random.choices("abcd" if random.random() < 0.5 else [str(i) for i in range(60)], k=random.randrange(1, 25))
            text += (block * random.randrange(1, 9))[:random.randrange(1, 120)]
        texts.append(text)
    number = collections.defaultdict(lambda: len(number))
    flat = np.array([number[w] for t in texts for w in t], dtype=np.int64)
    found = periodic.runs_of(flat, [len(t) for t in texts])
    assert sum(map(bool, found)) > 100
    for text, runs in zip(texts, found):
        assert runs == brute_runs(text), text
    assert periodic.runs_of(flat[:0], []) == []
    assert periodic.runs_of(flat[:0], [0, 0]) == [[], []]
    with pytest.raises(ValueError):
        periodic.runs_of(flat, [len(flat)], least_periods=2)


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_periodic_runs(llm, documents):
    found = {r[0]: tuple(r) for r in LLM_QUERIES["op13_periodic_runs"](llm, SF).collect()}
    assert len(found) == len(documents)
    for r in documents:
        assert found[r["doc_id"]] == expected_row(r["doc_id"], r["text"])
    assert sum(r[1] > 0 for r in found.values()) >= 0.05 * len(found)


def test_periodic_run_edges(llm, monkeypatch):
    monkeypatch.setattr(periodic, "PASS_WORDS", 64)
    rows = [(1, None, 1), (2, "", 1), (3, " \n\t ", 1), (4, "a b " * 30, 1), (4, "a b " * 30, 1), (None, "é\x0bü\x1c " * 40, 1), (5, LONG, 1)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, runs int").withColumns({"collapsed": F.lit(1), "n": F.lit(2), "w": F.lit(3)})
    found = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(docs).collect()]
    assert sorted(found, key=repr) == sorted([
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 60, 2)], "a b"), (4, [(0, 60, 2)], "a b"),
        (None, [(0, 80, 2)], "é ü\x1c"), (5, [(0, 200_000, 5)], "word and more of it,")], key=repr)
    assert periodic.periodic_runs(docs.where("false")).count() == 0
    planted = with_planted_runs(docs).collect()
    assert {r["doc_id"] for r in planted} == {1, 2, 3, 4, 5, None} and len(planted) == len(rows)
