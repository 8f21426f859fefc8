"""Queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from emberlane.plans import catalog

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(df):
    df = df[sorted(df.columns)]
    cell = lambda v: "" if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) or hasattr(v, "item") else str(v)
    return sorted(tuple(map(str, map(cell, r))) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"create view {f.removesuffix('.parquet')} as from '{DIR}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DIR).toPandas()
    if name in catalog.ORACLE:
        assert plain(got) == plain(duck.execute(catalog.ORACLE[name]).df())
    else:
        assert len(got) > 0
