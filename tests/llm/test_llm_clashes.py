"""Columns of the caller come back unharmed, whatever their names."""

import pytest
from pyspark.sql import functions as F

from airlane.llm import chat, decontaminate, langid, lexical, lines, mixing, periodic, simhash, token_counts, token_files, topk, warc
from airlane.llm.queries import tokenizer

#: Names of helper columns in any operator, now or before.
NAMES = ["row", "key", "row_key", "row_copies", "row_rows", "row_place", "row_times", "row_again", "copies", "rows", "place", "times",
         "again", "cuts", "h", "text_hash", "own_id", "text_key", "of", "size", "target", "p", "cell", "level", "none", "name", "share",
         "slot", "hits", "items", "words", "simhash", "root", "node", "u", "v", "component_id", "index", "word", "n", "bag", "class",
         "hash", "m", "bucket", "parts", "file", "start", "base", "a", "b", "site", "line", "at", "leaf", "path", "record_type", "digest"]
SAID = "one two three four five six seven eight nine ten eleven twelve thirteen"
ROWS = [(1, f"{SAID}\nshared line", "s"), (2, "alpha beta gamma\nshared line", "t"), (2, "alpha beta gamma\nshared line", "t"),
        (3, "alpha beta gamma\nshared line", None), (None, None, "s"), (4, "", "u")]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return plain, plain.withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in NAMES})


def unharmed(frame):
    names = [c for c in NAMES if c in frame.columns]
    rows = frame.select("doc_id", *[F.col(f"`{c}`") for c in names]).collect()
    assert rows and names == NAMES
    for r in rows:
        for c in names:
            assert r[c] == f"{c}:{'-' if r['doc_id'] is None else r['doc_id']}", c
    return sorted((str(r["doc_id"]) for r in rows))


def ids(frame):
    return sorted(str(r["doc_id"]) for r in frame.select("doc_id").collect())


def same(llm, one, two):
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.select(one.columns).collect()))


def test_carried_columns(llm, docs):
    plain, wide = docs
    bench = llm.createDataFrame([(9, SAID), (8, "alpha beta gamma"), (7, "zeta eta theta")], "item_id long, text string")
    assert unharmed(mixing.mix(wide, seed=3)) == ids(mixing.mix(plain, seed=3))
    assert unharmed(simhash.without_near_duplicates(wide)) == ids(simhash.without_near_duplicates(plain))
    assert unharmed(lines.without_shared_lines(wide, min_sites=2)) == ids(plain)
    for slice_rows in (decontaminate.SLICE_ROWS, 1):
        found = decontaminate.contamination(wide, bench, slice_rows=slice_rows, carry=True)
        assert unharmed(found) == ids(plain)
        same(llm, decontaminate.contamination(plain, bench), found)
    unharmed(token_counts.token_counts(wide, tokenizer("byte_bpe_50k.json")))
    unharmed(periodic.periodic_runs(wide))
    unharmed(langid.identify(wide, langid.train(wide.withColumn("lang", F.lit("en")))))


def test_ignored_columns(llm, docs):
    """Operators that return their own columns give the same with and without the caller's."""
    plain, wide = docs
    items = llm.createDataFrame([(9, "alpha"), (8, "one beta")], "item_id long, text string")
    path = tokenizer("word_bpe_49k.json")
    same(llm, token_files.token_files(plain, path), token_files.token_files(wide, path))
    same(llm, mixing.mixed(plain), mixing.mixed(wide))
    same(llm, simhash.groups(plain), simhash.groups(wide))
    same(llm, lexical.search(plain, items), lexical.search(wide, items.withColumns({c: F.lit(1) for c in NAMES})))
    vectors = llm.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id long, embedding array<float>")
    asks = F.col("vec_id") % 20 == 0
    same(llm, topk.top_k(topk.scaled(vectors), asks), topk.top_k(topk.scaled(vectors.withColumns({c: F.lit(1) for c in NAMES})), asks))
    pages = llm.createDataFrame([(1, "u", "x" * 2000), (2, "v", "x" * 2000), (3, None, None)], "page_id long, url string, html string")
    same(llm, warc.archived(pages), warc.archived(pages.withColumns({c: F.lit(1) for c in NAMES if c not in ("url", "html")})))
    turns = llm.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], "conv_id long, turn long, role string, text string")
    told = lambda t: chat.formatted(chat.branches(chat.linear_messages(t)))
    same(llm, told(turns), told(turns.withColumns({c: F.lit(1) for c in NAMES})))
