"""Registered queries against their SQL in DuckDB on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

from gridspark.plans import registry  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, float):
        return f"{v + 0.0:.9g}"
    return str(v).removesuffix(" 00:00:00")


def rows(names, table):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(value(r[i]) for i in order) for r in table)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    got = registry.queries()[name](spark, SF)
    want = db.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry_imports_and_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_predicates_reach_the_scan(spark):
    """The date range is a pushed filter and unread columns are pruned."""
    from gridspark.operators import crop
    from pyspark.sql import functions as F

    rows_ = spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_orderkey").between(1, 50)).select("o_orderkey", "o_orderdate")
    plan = rows_._jdf.queryExecution().explainString(rows_._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderkey,1)" in plan and "o_totalprice" not in plan
    assert crop.date_range(rows_.withColumn("date", F.to_date("o_orderdate")), "1995-01-01", "1999-01-01").count() >= 0
