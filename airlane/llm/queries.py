"""The thin queries over the provided tables, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.llm import (chat, decontaminate, langid, lexical, lines, mixing, periodic, simhash, token_counts, token_files,
                         topk, toxicity, warc)
from airlane.llm.common import prepare, table

#: Label columns in the order of the chain; a document above the threshold for the last is toxic.
CATEGORIES, THRESHOLD = ("low_quality", "toxic"), 0.5
SEARCH_EVERY, SEARCH_K = 20, 20


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity_labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                    "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    made = chat.stored(chat.formatted(chat.branches(chat.linear_messages(turns))), "chats")
    back = chat.read_back(made)
    ordered = F.array_sort(F.collect_list(F.struct("place", "role", "text", "masked")))
    digest = back.groupBy("leaf").agg(F.count("*").alias("n_turns"), ordered.alias("t"))
    told = F.concat_ws("", F.transform("t", lambda x: F.concat(x.role, F.lit("\n"), x.text, F.lit("\n"))))
    loss = F.concat_ws("", F.transform("t", lambda x: F.coalesce(x.masked, F.lit(""))))
    sizes = made.select("leaf", F.length("formatted").cast("long").alias("formatted_chars"))
    return digest.join(sizes, "leaf").select(
        F.col("leaf.conv_id").alias("conv_id"), "n_turns", F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % SEARCH_EVERY == 0, SEARCH_K)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, toxicity_labels(table(spark, sf_dir, "labels")), CATEGORIES)
    scored = toxicity.score(docs, chain, carry=False)
    return scored.withColumn("toxic", F.col("p_toxic") > THRESHOLD)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.without_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("cleaned").cast("long").alias("cleaned_chars"),
                          F.sha2("cleaned", 256).alias("cleaned_sha256"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json"), carry=False)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("copies")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.train(docs.where(~held))
    found = langid.identify(docs.select("doc_id", "text"), model, carry=False)
    return found.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the texts repeat a stretch of their own words up to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, w = F.floor(h / 10), F.regexp_extract_all("text", F.lit(r"([^ \t-\r]+)"), 1)
    a = F.pmod(g, F.col("n"))
    p = 1 + F.floor((F.col("n") - a) / (3 + g % 8))
    source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("w", source(i))), " ")
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, w).alias("w")).withColumn("n", F.size("w"))
    return chosen.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs, carry=False)
    ratio = lambda x, y: x["length"] * y["period"]  # noqa: E731  of x's exponent to y's, over a common denominator
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.lit(1), F.size("runs"))), F.get("runs", F.lit(0)), lambda x, y: F.when(
        (ratio(y, x) > ratio(x, y)) | ((ratio(y, x) == ratio(x, y)) & (y["start"] == x["start"]) & (y["period"] < x["period"])),
        y).otherwise(x))
    told = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines_ = F.when(F.size("runs") > 0, F.concat(told, F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines_, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP1_SQL = r"""
WITH all_turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|<?/?SYS>>)', '\1#\2', 'g'))
          + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|<?/?SYS>>)', '\1#\2', 'g'))
          + 8 + 8 + 8 AS chars
  FROM all_turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP2_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, [floor(64 * c::DOUBLE)::BIGINT for c in embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([c for c in embedding if c IS NOT NULL AND isfinite(c)]) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id, c.row,
    CAST(list_inner_product(q.x::DOUBLE[], c.x::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON c.row <> q.row WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS site, text,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE string_split(text, chr(10)) END AS parts FROM documents),
l AS (SELECT doc_id, site, unnest(parts) AS line FROM d),
common AS (SELECT line FROM l WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' GROUP BY line HAVING count(DISTINCT site) >= 5),
shared AS (SELECT coalesce(list(line), []) AS lines FROM common),
c AS (SELECT d.doc_id, d.text, len([x for x in parts if trim(x, ' ' || chr(9) || chr(13)) <> '']) AS n_lines, parts,
    [x for x in parts if NOT list_contains(shared.lines, x)] AS kept FROM d, shared)
SELECT doc_id, n_lines::BIGINT AS n_lines, (len(parts) - len(kept))::BIGINT AS n_removed,
  CASE WHEN text IS NOT NULL THEN length(coalesce(array_to_string(kept, chr(10)), ''))::BIGINT END AS cleaned_chars,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(array_to_string(kept, chr(10)), '')) END AS cleaned_sha256
FROM c
"""

OP5_SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS words
  FROM item, unnest(range(1, greatest(2, len(w) - 11))) AS t(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM low, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS t(i)
), hit AS (
  SELECT doc_id, i, places.n, item_id FROM places JOIN win ON places.words = win.words AND places.n = win.n
), sums AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM low LEFT JOIN sums USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
b AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM s)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
FROM b
"""

OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), whole AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL
), weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, whole GROUP BY term, n_docs
), scores AS (
  SELECT item_id, row, doc_id,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM tf JOIN weight USING (term) JOIN item USING (term), whole GROUP BY item_id, row, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""

LLM_QUERIES = {f.__name__: (lambda spark, sf_dir, f=f: f(prepare(spark), sf_dir)) for f in (
    op1_chat_format, op2_top_k, op3_toxicity, op4_line_dedup, op5_decontaminate, op6_token_counts,
    op7_token_files, op8_mix, op9_simhash, op10_warc, op11_language_id, op12_lexical_search, op13_periodic_runs)}
LLM_ORACLES = {"op1_chat_format": OP1_SQL, "op2_top_k": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_decontaminate": OP5_SQL,
               "op10_warc": OP10_SQL, "op12_lexical_search": OP12_SQL}
