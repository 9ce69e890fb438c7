from pyspark.sql import functions as F

from tollgate.plans import catalog
from tollgate.plans import fixtures as FX


def _tables(spark, path, ids):
    """customer (in one file), nation and region of the given customer ids."""
    rows = ids.select("c_custkey", F.lit("C").alias("c_name"), F.lit(0).cast("long").alias("c_nationkey"), F.lit("KILNS").alias("c_mktsegment"))
    rows.coalesce(1).write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(0, "A", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string").write.parquet(f"{path}/region.parquet")
    return str(path)


def test_responses_of_one_small_file_are_dealt_out_and_none_is_lost(spark, tmp_path):
    n = 200_000
    ids = spark.range(n).union(spark.range(5))  # five rows come twice, id 0 is null
    name = F.concat(F.lit("Customer#"), F.sha2(F.col("id").cast("string"), 256))
    rows = ids.select(F.when(F.col("id") > 0, F.col("id")).alias("c_custkey"), name.alias("c_name"), (F.col("id") % 2).alias("c_nationkey"), F.lit("KILNS").alias("c_mktsegment"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "A", 0), (1, "B", 0)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey long, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    out = FX.raw_responses(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("p"))
    got = out.agg(F.count("*").alias("n"), F.count("response_id").alias("known")).collect()
    assert max(r["n"] for r in got) < n / 2
    assert (sum(r["n"] for r in got), sum(r["known"] for r in got)) == (n + 5, n + 3)


def test_rows_of_a_few_bytes_are_dealt_out_too(spark, tmp_path):
    n = 4_000
    path = _tables(spark, tmp_path, spark.range(n).withColumnRenamed("id", "c_custkey"))
    got = FX.raw_responses(spark, path).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in got) == n
    assert len(got) > int(spark.conf.get("spark.sql.shuffle.partitions")) / 2


def test_only_wanted_responses_are_built_once_for_each_match(spark, tmp_path):
    keys = [1, 2, 2, 3, None]
    path = _tables(spark, tmp_path, spark.createDataFrame([(k,) for k in keys], "c_custkey long"))
    due = spark.createDataFrame([(2, 1), (2, 1), (3, 2), (9, 1), (None, 1)], "fetch_id long, attempt int")
    got = catalog._fetch_again(spark, path, "2024-01-31 02:10:00")(due)
    assert sorted((r["fetch_id"], r["attempt"]) for r in got.collect()) == [(2, 1)] * 4 + [(3, 2)]
    bodies = {r["response_id"]: r["body"] for r in FX.raw_responses(spark, path).collect()}
    assert all(r["body"] == bodies[r["fetch_id"]] for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    built = next(i for i, line in enumerate(plan) if '{"results":[{' in line)
    joined = next(i for i, line in enumerate(plan) if "Join Inner" in line and "fetch_id" in line)
    assert built < joined  # the body's projection stands above the join
