"""A corpus pipeline over ``documents``: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlane.llm import decontaminate, mixing, simhash, token_files, toxicity
from airlane.llm.common import prepare, stored, table
from airlane.llm.queries import CATEGORIES, THRESHOLD, tokenizer, toxicity_labels


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, fitted on their labelled part, does not call toxic."""
    chain = toxicity.train(docs, toxicity_labels(table(spark, sf_dir, "labels")), CATEGORIES)
    scored = toxicity.score(docs, chain, prefix="chain_p_")
    return scored.where(F.col("chain_p_toxic") <= THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of linked fingerprints."""
    return simhash.without_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    marked = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return marked.where(~F.col("contaminated")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not, once or twice."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Record files of token ids, read back: one row per document of the mix."""
    return token_files.token_files(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]

#: SQL can express neither the trained chain nor the drawn mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
