"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from records import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"stage", "first_error", "n"}
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(_norm(x) for x in r) for r in df.collect()]
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(res.columns) == sorted(cols)
    order = [res.columns.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in order) for r in res.fetchall()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(rows, key=key) == sorted(drows, key=key)


def test_every_query_has_an_oracle():
    from tollgate.plans.catalog import spark_entry_queries
    from tollgate.plans.oracle import ORACLE

    assert set(spark_entry_queries()) == set(ORACLE)


@pytest.mark.parametrize("name", ["route_outcomes", "is_email", "to_dead_letters", "publish_encode", "decode_messages", "user_contract_errors", "dlq_stats_all"])
def test_building_a_query_runs_nothing(spark, name):
    from tollgate.plans.catalog import spark_entry_queries

    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    spark_entry_queries()[name](spark, SF_SMALL)  # reads the files' footers
    sc.setJobGroup(f"build-{name}", "")
    try:
        df = spark_entry_queries()[name](spark, SF_SMALL)
        built = [j for j in tracker.getJobIdsForGroup(f"build-{name}") if (tracker.getJobInfo(j)) and len(tracker.getJobInfo(j).stageIds) > 1]
        assert not built and len(tracker.getJobIdsForGroup(f"build-{name}")) <= 4
        df.collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
