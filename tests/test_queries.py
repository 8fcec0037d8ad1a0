"""Every registered query equals its SQL on the smallest tables, and the entry runs."""

import duckdb
import pytest

import __spark_entry__
from corpusflow import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations sales".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def norm(v):
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted([tuple(norm(r[c]) for c in cols) for r in df.collect()], key=str)
    rel = duck.sql(registry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert got == sorted([tuple(norm(r[i]) for i in at) for r in rel.fetchall()], key=str)


def test_class_tree_at_size(spark):
    """More classes than the reference's cap."""
    con = duckdb.connect()
    con.execute("CREATE VIEW part AS SELECT * FROM '/root/testdata/sf0.1/part.parquet'")
    want = con.sql(registry.oracle_sql()["q23_class_tree"]).fetchall()
    got = [(r["node"], r["depth"]) for r in registry.queries()["q23_class_tree"](spark, "/root/testdata/sf0.1").collect()]
    assert len(want) == 11111 and sorted(got) == sorted(want)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, DIR).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 199  # one document is junk throughout
    assert set(registry.queries()) <= set(__spark_entry__.queries())
