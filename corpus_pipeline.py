"""A corpus pipeline of five stages; each is stored as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bit_sliced, mixing, packing, queries, secrets, toxicity
from quayside.session import configure, settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it is fitted on the labels of the documents given."""
    configure(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_toxicity(docs, model, name="toxicity_score")
    return scored.where(F.col("toxicity_score") < toxicity.THRESHOLD).drop("toxicity_score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    configure(spark)
    return bit_sliced.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    configure(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    configure(spark)
    return mixing.mix(docs, queries.MIX_LEVELS, queries.MIX_SHARE, queries.MIX_EPOCHS, queries.MIX_SEED, told=False)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of tokens."""
    configure(spark)
    return packing.pack_documents(docs, public_tokenizers.path(queries.TOKENIZER), queries.WINDOW)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: SQL cannot say the learned grammar, the entropy windows or the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before has stored."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
