"""Deletions in tables with a folder of their own, long lists, and other odd cases."""

import datetime as dt

from pyspark.sql import functions as F

import tickshard as ts
from tickshard.plans import tables

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def days(spark, numbers):
    rows = [(START + n * DAY + dt.timedelta(hours=1), n) for n in numbers]
    return spark.createDataFrame(rows, "`$timestamp` timestamp_ntz, x bigint")


def held(spark, table):
    return sorted(r.x for r in ts.read_table(spark, table).collect())


def test_deleted_rows_stay_deleted(spark, table_name, tmp_path):
    ts.write_dataframe(days(spark, range(10)), table_name, path=str(tmp_path / "t")).compute()
    ts.write_dataframe(days(spark, [3, 7]), table_name, push_mode="truncate").compute()
    ts.write_dataframe(days(spark, [5]), table_name).compute()
    assert held(spark, table_name) == [0, 1, 2, 3, 5, 7, 8, 9]
    moved = days(spark, [8]).withColumn("x", F.lit(5).cast("bigint"))
    upsert = {"deduplicate": ["x"], "deduplication_mode": "upsert"}
    ts.write_dataframe(moved, table_name, **upsert).compute()
    ts.write_dataframe(days(spark, [5]).withColumn("x", F.lit(50)), table_name).compute()
    assert held(spark, table_name) == [0, 1, 2, 3, 5, 7, 8, 9, 50]
    spark.catalog.refreshTable(table_name)
    assert spark.table(table_name).count() == 9


def test_long_lists_of_ranges_and_shards(spark, table_name):
    rows = spark.range(2000).select(
        (F.lit(START).cast("timestamp_ntz") + F.expr("make_dt_interval(0, id)")).alias("$timestamp"),
        F.col("id").alias("x"),
    )
    ts.write_dataframe(rows, table_name, shard_size="6h").compute()
    hour = dt.timedelta(hours=1)
    ranges = [(START + i * hour, START + i * hour + hour / 2) for i in range(0, 2000, 2)]
    found = ts.read_ranges(spark, table=table_name, ranges=ranges, column_names=["x"])
    assert sorted(r.x for r in found.collect()) == list(range(0, 2000, 2))
    few = ts.read_ranges(spark, table=table_name, ranges=ranges[:7], column_names=["x"])
    assert sorted(r.x for r in few.collect()) == list(range(0, 14, 2))
    in_list = spark.table(table_name).where(tables.in_shards(range(10**6, 10**6 + 9000, 3)))
    assert in_list.count() == 0


def test_asof_with_a_map(spark):
    left = days(spark, [2, 5])
    right = days(spark, [1, 4]).withColumn("m", F.create_map(F.lit("a"), "x"))
    found = ts.asof_join(left, right.drop("x"))
    assert {(r.x, r.m["a"]) for r in found.collect()} == {(2, 1), (5, 4)}


def test_sum_beyond_64_bits(spark):
    df = spark.createDataFrame([(2**62,)] * 3, "x bigint")
    assert int(ts.global_stats(df, "x").first().sum_x) == 3 * 2**62


def test_partition_is_slice_at_any_size(spark):
    df = days(spark, [0] * 500 + [9])
    parts = ts.partition_by_slice(df.coalesce(1), 4)
    assert parts.rdd.getNumPartitions() == 4
    sizes = parts.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert {r.p: r["count"] for r in sizes} == {0: 500, 3: 1}
    split = ts.partition_by_slice(df.coalesce(1), 4, split_rows=100)
    assert max(r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()) == 100
