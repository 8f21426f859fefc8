"""From raw documents to a tokenized training mix, in stages.

Each stage works on all that its predecessor kept. Stages read and return the
columns of documents; the last returns token ids.

Defined cases are those of the operators: null and blank texts fail the base rules
and go in the first stage; what is left may have null ids, languages and sources;
rows equal in doc_id and text become one in the second; a document is as often in
the mix as it is taken, none with no words; an empty table gives an empty result;
further columns of documents are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.llm import minhash, mixing, pieces, quality, secrets
from emberlane.llm.common import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality.kept_documents(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked, and n_chars of what is left."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    return pieces.tokenized(docs)


STAGES = [("quality", keep_good), ("near-duplicates", one_of_each), ("secrets", mask_secrets), ("mix", mix_sources), ("tokens", tokenize)]

# DartMinHash signatures, guess costs and merge agendas have no form in SQL: tests
# hold run() against the operators' brute-force versions, one after another.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
