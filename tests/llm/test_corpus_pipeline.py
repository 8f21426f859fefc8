"""The pipeline's stages on the smallest tables, each against what it was given."""

import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from emberlane.llm import minhash, mixing, quality, queries, secrets
from emberlane.llm.common import materialize

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    given = {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs
        docs = materialize(stage(spark, docs, DIR), "stage")
        if name != "tokens":
            assert docs.columns == given[name].columns
    rows = lambda df: {r["doc_id"]: r for r in df.collect()}
    after = {name: given[following] for (name, _), (following, _) in zip(corpus_pipeline.STAGES, corpus_pipeline.STAGES[1:])}
    assert set(rows(after["quality"])) == {r["doc_id"] for r in quality.quality(given["quality"]).where("kept").collect()}
    kept = {r["component_id"] for r in minhash.near_duplicates(given["near-duplicates"]).collect()}
    assert set(rows(after["near-duplicates"])) == kept
    before = rows(given["secrets"])
    for i, r in rows(after["secrets"]).items():
        assert r["text"] == secrets.redacted(before[i]["text"], secrets.find(before[i]["text"])) and r["n_chars"] == len(r["text"])
    taken = {r["doc_id"]: r["taken"] // max(r["size"], 1) for r in mixing.mix(given["mix"]).collect()}
    mixed = after["mix"].groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in mixed} == {k: v for k, v in taken.items() if v}
    assert docs.where("not lossless").count() == 0 and docs.count() == given["tokens"].count()
    whole = corpus_pipeline.run(spark, DIR)
    assert sorted(map(str, whole.select("doc_id", "n_tokens").collect())) == sorted(map(str, docs.select("doc_id", "n_tokens").collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings"):
        c.execute(f"create view {t} as from '{DIR}/{t}.parquet'")
    cell = lambda v: "" if pd.isna(v) else str(round(float(v), 5)) if hasattr(v, "item") or isinstance(v, float) else str(v)
    plain = lambda df: sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))
    assert plain(queries.QUERIES[name](spark, DIR).toPandas()) == plain(c.execute(queries.ORACLE[name]).df())


def test_every_operator_has_a_query():
    numbers = [int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 11)) and "pipeline" in entry.queries()
