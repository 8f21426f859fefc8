"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberlane.llm import chat, collocations, decontaminate, embeddings, minhash, mixing, negatives, pieces, quality, secrets, suffixes, superkmers, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_dedup(_table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_tricky(_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(turns))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))



def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.tokenized(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op9_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.substring_dedup(_table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffixes, op2_chat, op3_mix, op4_quality, op5_embeddings, op6_pieces, op7_warc, op8_secrets, op9_superkmers, op10_minhash, op11_negatives, op12_decontaminate, op13_phrases)}
ORACLE = {"op11_negatives": negatives.SQL, "op13_phrases": collocations.SQL, "op12_decontaminate": decontaminate.SQL, "op2_chat": chat.SQL, "op3_mix": mixing.SQL, "op4_quality": quality.SQL, "op5_embeddings": embeddings.SQL, "op7_warc": warc.SQL, "op9_superkmers": superkmers.SQL}
