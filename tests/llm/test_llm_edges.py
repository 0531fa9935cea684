"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns, hot groups."""

import collections
import hashlib
import io
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from airlane.llm import (chat, components, decontaminate, lines, mixing, simhash, token_counts, token_files, topk,
                         toxicity, warc)
from airlane.llm.common import scratch
from airlane.llm.queries import tokenizer

DOCS = "doc_id long, text string, source string"
LONG = "word and more of it, " * 40_000


def docs(llm, rows):
    return llm.createDataFrame(rows, DOCS)


# -- chat --------------------------------------------------------------------------------------------

MESSAGE = "node long, parent long, role string, text string, score double"


def trees(llm, rows, keep):
    found = chat.branches(llm.createDataFrame(rows, MESSAGE), keep).collect()
    paths = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: r["place"]):
        paths[r["root"], r["rank"], r["path_score"]].append(r["text"])
    return dict(paths)


def test_branches_rank_and_ties(llm):
    rows = [(1, None, "user", "a", 1.0), (2, 1, "assistant", "b", 2.0), (3, 1, "assistant", "c", 5.0), (4, 2, "user", "d", 3.0),
            (5, 3, "user", "e", None), (6, 99, "user", "orphan", 0.0), (7, 8, "user", "x", 9.0), (8, 7, "user", "y", 9.0),
            (None, None, "user", "no id", 1.0), (6, 99, "user", "orphan", 0.0)]
    assert trees(llm, rows, 2) == {(1, 1, 6.0): ["a", "b", "d"], (1, 2, 6.0): ["a", "c", "e"], (6, 1, 0.0): ["orphan"]}
    assert trees(llm, rows, 1) == {(1, 1, 6.0): ["a", "b", "d"], (6, 1, 0.0): ["orphan"]}
    assert trees(llm, [], 1) == {}


def test_branches_of_random_trees(llm):
    random.seed(3)
    rows = [(i, random.randrange(i) if i % 40 and random.random() < 0.9 else (i - 1 if i % 40 else None), "user", str(i),
             float(random.randrange(5))) for i in range(400)]
    up, kids = {r[0]: r[1] for r in rows}, {r[1] for r in rows}
    expected = collections.defaultdict(list)
    for leaf in (r[0] for r in rows if r[0] not in kids):
        path = [leaf]
        while up[path[-1]] is not None:
            path.append(up[path[-1]])
        expected[path[-1]].append((-sum(rows[n][4] for n in path), leaf, [str(n) for n in path[::-1]]))
    expected = {(root, k + 1, -s): path for root, of in expected.items() for k, (s, _, path) in enumerate(sorted(of)[:3])}
    assert trees(llm, rows, 3) == expected


def test_chat_round_trip(llm):
    texts = ["", None, "\\", "<|turn|>", "<\\|turn|>", "</s>[INST] x [/INST]", "<<SYS>>\\\\<|", "\n\né🙂", "[[INST]]<<s>"]
    turns = [(None, None, None, "n"), (None, 1, "assistant", "a")] + [
        (7, i, "assistant" if i % 2 else "<|says|>", t) for i, t in enumerate(texts)] + [(8, 0, "user", LONG), (8, 0, "user", LONG)]
    made = chat.formatted(chat.branches(chat.linear_messages(
        llm.createDataFrame(turns, "conv_id long, turn long, role string, text string"))))
    back = collections.defaultdict(list)
    for r in chat.read_back(made).orderBy("place").collect():
        back[r["leaf"]["conv_id"]].append((r["role"], r["text"], r["masked"]))
    assert back[None] == [("", "n", None), ("assistant", "a", "a")]
    assert back[7] == [("assistant" if i % 2 else "<|says|>", t or "", (t or None) if i % 2 else None) for i, t in enumerate(texts)]
    assert back[8] == [("user", LONG, None)] * 2


# -- top k -------------------------------------------------------------------------------------------


def test_top_k_edges(llm):
    random.seed(1)
    vectors = [(i, [random.gauss(0, 0.2) for _ in range(6)]) for i in range(300)] + [(300 + i, [0.5] * 6) for i in range(60)]
    vectors += [(1000, None), (1020, [None] * 6), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (None, [1.0] * 6),
                (1080, [1.0]), (1100, [0.0] * 6), (40, vectors[40][1])]
    frame = llm.createDataFrame(vectors, "vec_id long, embedding array<float>")
    frame = frame.withColumns({c: F.lit("x") for c in ("x", "d", "row", "asks", "rank", "score", "query_id")})
    check_top_k(frame, vectors, 6)
    assert topk.top_k(topk.scaled(frame.limit(0)), F.col("vec_id") % 20 == 0).collect() == []


def check_top_k(frame, vectors, width):
    """Every row a candidate and, if its id is divisible by 20, a query of its own: whole numbers in plain Python."""
    held = [(i, [math.floor(64 * float(c)) for c in v] + [0] * (width - len(v))) for i, v in vectors
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    expected = collections.Counter()
    for a, (q, x) in enumerate(held):
        if q % 20 == 0:
            every = sorted((-sum(m * n for m, n in zip(x, y)), c) for b, (c, y) in enumerate(held) if b != a)[:20]
            expected.update((q, r + 1, c, -s) for r, (s, c) in enumerate(every))
    for block_rows, slice_bytes in ((topk.BLOCK_ROWS, topk.SLICE_BYTES), (50, 4 * 8 * width)):
        found = topk.top_k(topk.scaled(frame), F.col("vec_id") % 20 == 0, 20, block_rows, slice_bytes).collect()
        assert collections.Counter(map(tuple, found)) == expected


def test_top_k_of_wide_and_large_vectors(llm):
    random.seed(4)
    for width, size in ((128, 0.3), (128, 1e3), (3, 3e6), (1, 4e7)):
        vectors = [(i % 150, [random.uniform(-size, size) for _ in range(width)]) for i in range(160)]
        check_top_k(llm.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3), vectors, width)


def test_scores_beyond_64_bits_raise(llm):
    rows = [(0, [6e6] * 128), (1, [6e6] * 128), (2, [1.0] * 128)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        topk.top_k(topk.scaled(frame), F.col("vec_id") == 0)
    with pytest.raises(ValueError):
        topk.top_k(topk.scaled(llm.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")), F.col("vec_id") == 0)


def test_threshold_stops_early():
    rng = np.random.default_rng(5)
    block = rng.integers(-20, 20, (30_000, 3))
    query, best = np.array([[5, -3, 1]]), topk.Best(1, 20)
    topk.search_block(query, np.array([-1]), block, np.arange(30_000), np.arange(30_000), best)
    scores, ids = best.of[0][0], best.of[0][1]
    every = block @ query[0]
    order = np.lexsort((np.arange(30_000), -every))[:20]
    assert ids.tolist() == order.tolist() and scores.tolist() == every[order].tolist()


# -- toxicity ----------------------------------------------------------------------------------------


def test_chain_uses_earlier_categories(llm):
    random.seed(2)
    plain = ["apple", "table", "river", "green", "cloud"]
    rows, labels = [], []
    for i in range(300):
        rude, threat = i % 3 == 0, i % 6 == 0
        text = " ".join(random.choices(plain, k=12) + ["nitwit"] * rude + ["beware"] * threat)
        rows.append((i, text, "s"))
        labels.append((i, int(rude), int(rude and threat)))
    rows += [(900, None, "s"), (901, "", "s"), (902, "apple river green table nitwit", None),
             (903, "apple river green table nitwit beware", "s"), (904, LONG, "s"), (None, "apple", "s")]
    frame = docs(llm, rows).withColumn("p_rude", F.lit("clash"))
    marks = llm.createDataFrame(labels + [(0, None, 1)], "doc_id long, rude int, threat int")
    chain = toxicity.train(frame, marks, ("rude", "threat"), max_rows=250)
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1 and chain.weights[1][-2] > 0
    found = toxicity.score(frame, chain)
    assert found.columns == ["doc_id", "text", "source", "p_rude", "p_threat"]
    p = {r["doc_id"]: (r["p_rude"] > 0.5, r["p_threat"] > 0.5) for r in found.collect()}
    assert [p[900], p[901], p[902], p[903], p[904], p[None]] == [
        (False, False), (False, False), (True, False), (True, True), (False, False), (False, False)]
    assert sum(p[i] == (i % 3 == 0, i % 6 == 0) for i in range(300)) >= 295
    none = toxicity.train(frame, marks.limit(0), ("rude", "threat"))
    assert all(r["p_threat"] < 0.01 for r in toxicity.score(frame, none).collect())
    assert toxicity.score(frame.limit(0), chain).count() == 0


# -- lines -------------------------------------------------------------------------------------------


def test_shared_lines_go(llm):
    rows = [(i, f"own {i}\nshared by all\n\nshared by all\nfour {i if i >= 4 else ''}\nend {i}", f"s{i % 9}") for i in range(45)]
    rows += [(100, None, "s0"), (101, "", None), (102, "shared by all", None), (103, LONG, "s1"), (104, "own 1", "s1"),
             (None, "shared by all\nx", "s2"), (100, "shared by all\nother", "s2"), (102, "shared by all", None)]
    frame = docs(llm, rows).withColumn("n_lines", F.lit("clash"))
    found = lines.without_shared_lines(frame, min_sites=5).collect()
    assert len(found) == len(rows)
    sites = collections.defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip():
                sites[line].add(site)
    expected = collections.Counter()
    for i, text, site in rows:
        kept = None if text is None else "\n".join(x for x in text.split("\n") if len(sites[x]) < 5)
        whole = [x for x in (text or "").split("\n") if x.strip()]
        expected[i, kept, len(whole), sum(len(sites[x]) >= 5 for x in whole)] += 1
    assert collections.Counter((r["doc_id"], r["cleaned"], r["n_lines"], r["n_removed"]) for r in found) == expected
    assert lines.without_shared_lines(frame.limit(0)).count() == 0


def test_near_threshold_lines_are_exact(llm):
    rows = [(n * 100 + i, f"line {n}", f"site {i}") for n in (90, 99, 100, 101, 110, 200) for i in range(n)]
    found = lines.shared_lines(lines.line_table(docs(llm, rows)), 100)
    assert found.count() == 4


# -- decontamination ---------------------------------------------------------------------------------


def brute_hits(text, items):
    w = decontaminate.words((text or "").encode())
    hit, named = set(), set()
    for item, t in items:
        x = decontaminate.words((t or "").encode())
        n = min(13, len(x))
        for window in {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if x else ():
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) == window:
                    hit.update(range(i, i + n))
                    named |= {item} - {None}
    digest = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
    return len(w), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(w)


def test_contamination_edges(llm):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["é", "ÉA"]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(i, text(random.choice([1, 2, 3, 5, 8, 13, 14, 40]))) for i in range(25)]
    items += [(100, None), (101, "..."), (102, items[3][1]), (None, text(20)), (3, items[3][1]), (103, "a a a a a a a a a a a a a a a")]
    rows = []
    for i in range(60):
        body = random.choice([t for _, t in items if t])
        rows.append((i, text(random.randrange(60)) + "; " + body.upper().replace("É", "é") + " " + text(random.randrange(40)), "s"))
    rows += [(200, None, "s"), (201, "", "s"), (202, "?!", "s"), (203, "a " * 40, "s"), (204, LONG, "s"), (None, items[7][1], "s"),
             (5, rows[5][1], "s")]
    expected = collections.Counter((i, *brute_hits(t, items)) for i, t, _ in rows)
    frame = docs(llm, rows).withColumn("n_hit", F.lit("clash"))
    bench = llm.createDataFrame(items, "item_id long, text string")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for slice_rows in (200_000, 60):
        for carry in (False, True):
            found = decontaminate.contamination(frame, bench, slice_rows=slice_rows, carry=carry)
            assert collections.Counter(tuple(r) for r in found.select(names).collect()) == expected
            assert ("source" in found.columns) == carry
    none = decontaminate.contamination(frame, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r["n_hit"] or r["contaminated"] for r in none)
    assert decontaminate.contamination(frame.limit(0), bench).count() == 0


# -- tokens ------------------------------------------------------------------------------------------

ODD = [None, "", " ", "\n\n ", "a  b", "a\t\tb", "x  y  z", "café's  你好", "<|endoftext|>a <|endoftext|>", "<|ENDOFTEXT|>",
       "<|startoftext|> b", "it's I'LL '' ''s", "a \x1c b\x85c", "　  x", "end. \n", "ou, ou. ou!! 12,3 A,", "İΣ Σ.", "é É",
       "﻿a b", "a​ b", " .", "\x0b\x0cx", "9" * 300, "z" * 5000, LONG]


def test_token_counts_equal_the_library(llm):
    path = tokenizer("byte_bpe_50k.json")
    counter = token_counts.PieceCounter(path, {b" of": 1}, cache_rows=40)
    expected = [len(counter.tokenizer.encode(t or "", add_special_tokens=False).ids) for t in ODD]
    for _ in range(2):
        for t, n in zip(ODD, expected):
            assert counter([(t or "").encode()]) == [n], t
    found = token_counts.token_counts(docs(llm, [(i, t, "s") for i, t in enumerate(ODD)] + [(3, ODD[3], None)]), path).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_bytes"]) for r in found) == sorted(
        [(i, n, len((t or "").encode())) for i, (t, n) in enumerate(zip(ODD, expected))] + [(3, expected[3], 3)])
    assert token_counts.token_counts(docs(llm, []), path).count() == 0


def test_word_encoder_equals_the_library():
    encoder = token_files.WordEncoder(tokenizer("word_bpe_49k.json"), cache_rows=30)
    assert encoder.by_word
    for t in [t or "" for t in ODD] * 2:
        ids = encoder.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder([t.encode()])[0], "<u4").tolist() == ids, t


def test_token_files_round_trip(llm):
    path, uri = tokenizer("word_bpe_49k.json"), scratch(llm, "records")
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, "no id", "s"), (4, "again", "s"), (4, ODD[4], "s"), (4, ODD[4], "s")]
    files = token_files.write_token_files(docs(llm, rows), path, uri, file_bytes=2_000)
    assert files.count() > 3
    found = token_files.read_token_files(llm, files, uri).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    assert [r["start"] for r in found] == np.cumsum([0, *[r["n_tokens"] for r in found]])[:-1].tolist()
    encoder = token_files.WordEncoder(path)
    crc = lambda t: zlib.crc32(encoder([(t or "").encode()])[0] + b"\1\0\0\0")
    assert collections.Counter((r["doc_id"], r["ids_crc32"]) for r in found) == collections.Counter((i, crc(t)) for i, t, _ in rows)
    for row in files.collect():
        number = row["records"] - 1
        _, values = token_files.read_record(uri, row["file"], number)
        assert values[-1] == 1
    assert token_files.token_files(docs(llm, []), path).count() == 0


def test_damaged_records_are_found():
    data = token_files.frame(token_files.pack(7, np.array([1, 70_000])))
    assert [token_files.unpack(p)[1].tolist() for p in token_files.frames(io.BytesIO(data))] == [[1, 70_000]]
    for i in range(len(data)):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(ValueError):
            list(token_files.frames(io.BytesIO(bytes(bad))))


# -- mixing ------------------------------------------------------------------------------------------


def test_mix_edges(llm):
    random.seed(6)
    rows = [(i, "w " * random.randrange(1, 60), random.choice(["a", "b", "c", None])) for i in range(600)]
    rows += [(1000, None, "a"), (1001, "", "b"), (1002, LONG, "d"), (None, "x y", "c"), (3, rows[3][1], rows[3][2])]
    rows += [(2000, "same words here", "e")] * 300 + [(1003, "", "f")]
    frame = docs(llm, rows).withColumn("copies", F.lit("clash"))
    for group_rows, fan_in in ((20_000, 64), (25, 3)):
        found = mixing.mixed(frame, 8, group_rows, fan_in).collect()
        assert len(found) == len(rows) and found and all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in found)
        taken, goal = collections.Counter(), {}
        for r in found:
            goal[r["source_size"]] = r["target"]
            taken[r["source_size"]] += r["taken"]
        assert sum(goal.values()) == pytest.approx(1.5 * sum(r["size"] for r in found))
        assert all(abs(taken[s] - goal[s]) <= 60 for s in goal if s < 50_000)
        assert all(goal[s] <= 2 * s for s in goal)
        mixed = mixing.mix(frame, 8, group_rows, fan_in)
        assert mixed.columns == frame.columns
        times = collections.Counter((r["doc_id"], r["text"]) for r in mixed.collect())
        copies = collections.Counter()
        for r in found:
            copies[r["doc_id"], r["size"]] += r["copies"]
        assert sum(times.values()) == sum(copies.values()) and times[2000, "same words here"] == copies[2000, 3]
        again = mixing.mixed(frame.repartition(5), 8, group_rows, fan_in).collect()
        assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, found))
    assert mixing.mixed(frame.limit(0)).count() == 0 and mixing.mix(frame.limit(0)).count() == 0
    assert [r["taken"] for r in mixing.mixed(docs(llm, [(1, "", None)])).collect()] == [0]


def test_rounding_keeps_expectations():
    import pandas as pd

    rows = pd.DataFrame({"doc_id": range(40), "h": 0, "size": [1 + i % 7 for i in range(40)], "p": [0.3] * 20 + [0.55] * 20})
    total, runs = np.zeros(40), 3000
    for seed in range(runs):
        p = mixing._round(rows, seed)["p"].to_numpy()
        assert ((0 < p) & (p < 1)).sum() <= 1
        assert (p * rows["size"]).sum() == pytest.approx((rows["p"] * rows["size"]).sum())
        total += p
    assert np.abs(total / runs - rows["p"]).max() < 0.04


# -- simhash -----------------------------------------------------------------------------------------


def brute_roots(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return collections.Counter(find(p) for p in prints).values(), find


@pytest.mark.parametrize("paired", [0, 4, 33])
def test_links_lose_no_component(llm, paired):
    random.seed(7)
    prints = set()
    for _ in range(12):
        p = random.getrandbits(64)
        for _ in range(30):
            prints.add(p)
            p ^= 1 << random.randrange(64) if random.random() < 0.5 else 1 << random.randrange(64) | 1 << random.randrange(64)
    base = random.getrandbits(64)
    prints |= {base ^ 1 << a ^ 1 << b for a in range(20) for b in range(20)} | {0, 1 << 63, 3, 7}
    prints = sorted(prints)
    sizes, _ = brute_roots(prints)
    signed = [p - (1 << 64 if p >> 63 else 0) for p in prints]
    edges = simhash.links(llm.createDataFrame([(p,) for p in signed], "simhash long"), paired)
    assert edges.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 2).count() == 0
    found = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert sorted(collections.Counter(found.get(p, p) for p in signed).values()) == sorted(sizes)


def test_components_of_a_path_and_a_star(llm):
    edges = [(i, i + 1) for i in range(70)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (4, 3), (3, 4)]
    found = {r["node"]: r["root"] for r in components.components(llm.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 71)}, **{1000 + i: 1000 for i in range(1, 300)}}
    assert components.components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates(llm):
    rows = [(9, None, "s"), (8, "", "s"), (7, " \n", "s"), (1, "one", "s"), (2, "ONE", "s"), (3, "one two three four", "s"),
            (4, "one  two\tthree four", "s"), (5, LONG, "s"), (6, LONG, "s"), (6, LONG, "s"), (1, "one", "s"), (None, "one", "s"),
            (None, "alone among these", "s")]
    frame = docs(llm, rows).withColumn("simhash", F.lit("clash"))
    found = collections.Counter((r["doc_id"], r["component_id"]) for r in simhash.groups(frame).collect())
    assert found == {(9, 7): 1, (8, 7): 1, (7, 7): 1, (1, 1): 2, (2, 1): 1, (3, 3): 1, (4, 3): 1, (5, 5): 1, (6, 5): 2,
                     (None, 1): 1, (None, None): 1}
    kept = simhash.without_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept.collect()) == {
        (7, " \n"): 1, (1, "one"): 1, (3, "one two three four"): 1, (5, LONG): 1, (None, "alone among these"): 1}
    assert simhash.groups(frame.limit(0)).count() == 0


def test_long_texts_tally_in_parts(monkeypatch):
    text = " ".join(str(i * i) for i in range(500)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "TALLY", 7)
    assert simhash.fingerprint(text) == whole


# -- web archives ------------------------------------------------------------------------------------


def test_revisits(llm):
    big, other = "x" * 1000, "é" * 600
    rows = [(1, "http://a/", big), (2, "http://b/ c\r\nd", big), (3, None, big), (3, None, big), (4, "http://a/", "x" * 999),
            (5, "http://a/", "x" * 999), (6, "http://a/", None), (7, "http://a/", ""), (8, "http://é/", other), (None, "u", other),
            (9, "u", LONG), (6, "http://a/", None), (None, None, "\r\n\r\nWARC/1.1\r\n")]
    frame = llm.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("clash"))
    uri = scratch(llm, "warc")
    files = warc.write_archives(frame, uri, file_bytes=4_000)
    found = warc.read_archives(llm, files, uri).collect()
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    kind = {1: ("revisit", 3), 2: ("revisit", 3)}
    expected = collections.Counter()
    for i, _, t in rows:
        what = kind.get(i, ("response", None))
        what = ("revisit", 8) if i is None and t == other else what
        expected[i, len((t or "").encode()), digest(t), *what] += 1
    expected[3, 1000, digest(big), "response", None] -= 1
    expected[3, 1000, digest(big), "revisit", 3] += 1
    assert collections.Counter(map(tuple, found)) == expected
    assert warc.archived(frame.limit(0)).count() == 0


def test_token_counts_in_runs_and_tiers():
    """Odd texts among others, cut into small runs, with tiny tiers and long pieces: as the library."""
    counter = token_counts.PieceCounter(tokenizer("byte_bpe_50k.json"), {b" of": 1, b"\n\n": 1}, cache_rows=30)
    random.seed(4)
    texts = [random.choice([random.choice(ODD), " ".join(random.choice(["of", "a.\nb", "é", "", "x" * 60, "\t"]) for _ in range(9))])
             for _ in range(300)]
    expected = counter.encode([t or "" for t in texts])
    assert counter.counted(pa.array(texts, pa.string())).tolist() == expected
    assert counter.counted(pa.chunked_array([pa.array(texts[:9], pa.string()), pa.array(texts[9:], pa.string())])).tolist() == expected
    assert counter.counted(pa.array([], pa.string())).tolist() == []
    assert not any(len(p) > token_counts.PIECE_CHARS for p in [*counter.cache, *counter.parts])


def test_the_frequent_pieces_come_from_all_documents(llm):
    """Pieces of the last rows, frequent there alone, reach the table; the bounded counter keeps the commonest."""
    path = tokenizer("byte_bpe_50k.json")
    rows = [(i, f"start u{i} v{i}", "s") for i in range(600)] + [(1000 + i, "start late " * 3 + "end", "s") for i in range(40)]
    table = token_counts.frequent_pieces(docs(llm, rows), path, entries=3)
    assert set(table) == {b" start", b" late", b"start"} and all(n >= 1 for n in table.values())
    told = token_counts.commonest(iter([([f"p{i}", "often"], np.array([1, 5])) for i in range(100)]), rows=10, told=1)
    assert told == [("often", 500)]
