"""The bucketed user state and the check of the user table's columns."""

import datetime as dt
import re

import pytest

from tollgate.operators.contracts import USER_COLUMNS
from tollgate.session import fresh_dir
from tollgate.sources import sinks as S
from tollgate.sources import user_state as US

SCHEMA = ", ".join([*(f"{c} string" for c in USER_COLUMNS), "_ts timestamp", "_partition int", "_offset long"])


def batch(spark, rows):
    """Rows (id, city, second, offset) as decoded messages."""
    at = dt.datetime(2026, 1, 1)
    full = [tuple({"id": i, "first_name": name}.get(c) for c in USER_COLUMNS) + (at + dt.timedelta(seconds=s), 0, o) for i, name, s, o in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture
def log(spark):
    """A change log and the state after its first batches: a hot id, late and repeated messages, ties."""
    path, folder = fresh_dir(spark, "users"), fresh_dir(spark, "state")
    first = [(f"u{i:03}", "a", i, i) for i in range(200)] + [("hot", f"h{i}", i, 1000 + i) for i in range(300)]
    S.upsert_users(batch(spark, first), 0, path)
    S.upsert_users(batch(spark, [("u001", "b", 500, 5000), ("u002", "late", 0, 0), ("new", "n", 1, 1), (None, "x", 1, 1)]), 1, path)
    US.compact(spark, path, folder, buckets=4)
    S.upsert_users(batch(spark, [("u003", "c", 900, 9000), ("u001", "older", 400, 4000), ("hot", "tie", 299, 1299), (None, "y", 1, 1)]), 2, path)
    return path, folder


def names(df):
    return {r["id"]: r["first_name"] for r in df.select("id", "first_name").collect()}


def test_state_and_newer_batches_equal_the_log(spark, log):
    path, folder = log
    want = names(S.current_users(spark, path).where("id is not null"))
    assert want["u001"] == "b" and want["u002"] == "a" and want["u003"] == "c" and len(want) == 202
    want["hot"] = "h299"  # a message of the same place is the same message: the first stays
    assert names(US.users(spark, path, folder, 4)) == want
    assert US.compact(spark, path, folder, 4) == 2
    assert names(US.users(spark, path, folder, 4)) == want
    assert US.compact(spark, path, folder, 4) == 2
    assert US.state(spark, folder, 4).count() == 202


def test_the_state_is_not_shuffled(spark, log):
    path, folder = log
    old = US.state(spark, folder, 4)
    new = US._newer(spark, path, 1)
    plan = US.merged(old, new, 4)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    sides = re.split(r"\n(?=[ :]*[+:]- )", plan[join:])
    state_scan = next(i for i, s in enumerate(sides) if "Bucketed: true" in s)
    assert not any("Exchange" in s for s in sides[:state_scan]), plan
    assert "Exchange" in plan


def test_lookup_reads_one_bucket(spark, log):
    path, folder = log
    plan = US.state(spark, folder, 4).where("id = 'u003'")._jdf.queryExecution().sparkPlan()
    assert plan.collectLeaves().apply(0).optionalBucketSet().get().cardinality() == 1
    assert names(US.lookup(spark, path, folder, ["u003", "u004", "nobody"], 4)) == {"u003": "c", "u004": "a"}
    with pytest.raises(ValueError):
        US.lookup(spark, path, folder, [], 4)


def test_a_catalog_without_the_entry_and_a_failed_run(spark, log):
    path, folder = log
    spark.sql(f"DROP TABLE {US._name(US._root(folder, 4), 1)}")
    assert US.state(spark, folder, 4).count() == 202
    batch(spark, [("half", "x", 1, 1)]).write.parquet(f"{folder}/buckets=4/upto=2")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/buckets=4/upto=2/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert "half" not in names(US.users(spark, path, folder, 4))
    US.compact(spark, path, folder, 4)
    assert "half" not in names(US.users(spark, path, folder, 4)) and US.state(spark, folder, 4).count() == 202


def test_another_bucket_count_is_another_state(spark, log):
    path, folder = log
    assert US.state(spark, folder, 8) is None
    US.compact(spark, path, folder, 8)
    assert names(US.users(spark, path, folder, 8)).keys() == names(US.users(spark, path, folder, 4)).keys()


def test_user_table_of_another_schema_is_refused(spark):
    columns = [c for c in USER_COLUMNS if c != "email"]
    spark.sql(f"CREATE TABLE users_odd ({', '.join(f'{c} STRING' for c in columns)}, email INT) USING parquet LOCATION '{fresh_dir(spark, 'odd')}'")
    spark.sql(f"CREATE TABLE users_short ({', '.join(f'{c} STRING' for c in columns)}) USING parquet LOCATION '{fresh_dir(spark, 'short')}'")
    spark.sql(f"CREATE TABLE users_more ({', '.join(f'{c} STRING' for c in USER_COLUMNS)}, extra INT) USING parquet LOCATION '{fresh_dir(spark, 'more')}'")
    with pytest.raises(ValueError, match="email: int instead of string"):
        S.ensure_users_table(spark, "users_odd", fresh_dir(spark, "odd"))
    with pytest.raises(ValueError, match="email: missing"):
        S.ensure_users_table(spark, "users_short", fresh_dir(spark, "short"))
    assert "extra" in S.ensure_users_table(spark, "users_more", fresh_dir(spark, "more")).columns
    for name in ("users_odd", "users_short", "users_more"):
        spark.sql(f"DROP TABLE {name}")
