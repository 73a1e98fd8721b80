"""Every registered query against its checking SQL on the smallest data."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spark_entry
import check
from opsight.plans.catalogue import QUERIES
from tests.conftest import plan_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_operator_of_the_inventory_is_registered():
    # Q21 only makes rows and reads no table, so it is a function without a query
    assert {name[:3] for name in QUERIES} == {f"q{i:02d}" for i in range(1, 63) if i != 21}
    assert set(QUERIES) <= set(spark_entry.oracle_sql()) and set(QUERIES) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(spark, engine, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    rel = engine.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    want = Counter(tuple(check.plain(r[i]) for i in order) for r in rel.fetchall())
    got = Counter(tuple(check.plain(v) for v in r) for r in df.collect())
    assert got == want
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
