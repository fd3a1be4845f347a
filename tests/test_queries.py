"""Every registered query with SQL against DuckDB on the smallest tables; the others run."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpusmill.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    v = v.item() if hasattr(v, "item") else v
    return round(v, 6) if isinstance(v, float) else v if isinstance(v, (bool, int)) else str(v)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in SQL:
        assert len(got.columns) > 0
        return
    want = duck.execute(SQL[name]).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    rows = lambda df: sorted((tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False)), key=repr)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["analysis_context", "duplicate_groups", "greedy_batch_filter", "semantic_candidates_capped"])
def test_partitioning_does_not_matter(spark, name):
    first = sorted(map(tuple, QUERIES[name](spark, DATA).collect()), key=repr)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert sorted(map(tuple, QUERIES[name](spark, DATA).collect()), key=repr) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
