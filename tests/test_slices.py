import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tickshard as ts

START = dt.datetime(1969, 6, 1)
DAY = 86_400_000_000


def frame(spark, offsets, start=START):
    rows = [(i, start + dt.timedelta(microseconds=o)) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "id bigint, `$timestamp` timestamp_ntz")


def expected(offset, span, n):
    """The last slice whose bound is not above the offset, by the bounds themselves."""
    return max(i for i in range(n) if i * span // n <= offset)


@pytest.mark.parametrize("span", [1, 2, 3, 104 * DAY, 105 * DAY, 400 * DAY, 7 * 365 * DAY + 1])
@pytest.mark.parametrize("n", [1, 2, 3, 7, 100])
def test_slices_are_exact(spark, span, n):
    edges = {min(max(i * span // n + d, 0), span - 1) for i in range(n + 1) for d in (-1, 0, 1)}
    offsets = sorted(edges | {0, span - 1})
    rows = ts.with_slice(frame(spark, offsets), n).collect()
    assert [r["$slice"] for r in rows] == [expected(o, span, n) for o in offsets]
    bounds = ts.slice_bounds(frame(spark, offsets), n).orderBy("slice").collect()
    assert bounds[0].lo == START
    assert bounds[-1].hi == START + dt.timedelta(microseconds=span)
    assert all(a.hi == b.lo for a, b in zip(bounds, bounds[1:]))
    by_slice = {b.slice: b for b in bounds}
    assert all(by_slice[r["$slice"]].lo <= r["$timestamp"] < by_slice[r["$slice"]].hi for r in rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    offsets=st.lists(st.integers(0, 200 * 365 * DAY), min_size=1, max_size=30),
    n=st.integers(1, 2**20),
)
def test_random_slices_are_exact(spark, offsets, n):
    first = min(offsets)
    span = max(offsets) - first + 1
    rows = ts.with_slice(frame(spark, offsets, dt.datetime(1900, 1, 1)), n).collect()
    got = {r["id"]: r["$slice"] for r in rows}
    assert got == {i: ((o - first + 1) * n - 1) // span for i, o in enumerate(offsets)}


def test_one_partition_per_slice_in_time_order(spark):
    df = frame(spark, [i * i * 1_000_000 for i in range(500)]).repartition(5)
    parts = ts.partition_by_slice(df, 6)
    assert parts.rdd.getNumPartitions() == 6
    with_part = parts.withColumn("p", F.spark_partition_id())
    check = ts.with_slice(with_part, 6).where("p <> `$slice`")
    assert check.count() == 0 and parts.count() == 500
    times = [r[0] for r in parts.select("$timestamp").collect()]
    assert times == sorted(times)


def test_hot_slice_takes_several_partitions(spark):
    """Two thirds of the rows are copies of one row; no key could tell them apart."""
    copies = spark.range(0, 4000, 1, 16).select(
        F.lit(7).cast("bigint").alias("id"), F.lit(START + dt.timedelta(days=5)).cast("timestamp_ntz").alias("$timestamp")
    )
    df = copies.unionByName(frame(spark, [i * DAY // 200 for i in range(2000)]))
    parts = ts.partition_by_slice(df, 4, split_rows=1000)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 1100
    assert parts.exceptAll(df).count() == df.exceptAll(parts).count() == 0


def test_more_slices_than_instants_lose_nothing(spark):
    parts = ts.partition_by_slice(frame(spark, [0, 0, 1]), 10)
    assert parts.rdd.getNumPartitions() == 10 and parts.count() == 3


def test_empty_frame(spark):
    empty = frame(spark, [])
    assert ts.slice_bounds(empty, 3).count() == 0
    assert ts.with_slice(empty, 3).count() == 0
    parts = ts.partition_by_slice(empty, 3)
    assert parts.schema == empty.schema and parts.count() == 0


def test_rows_without_a_time_are_kept(spark):
    df = frame(spark, [0, 5]).unionByName(
        spark.sql("SELECT 9L AS id, CAST(NULL AS TIMESTAMP_NTZ) AS `$timestamp`")
    )
    assert ts.partition_by_slice(df, 2).count() == 3


@pytest.mark.parametrize("n", [0, -1, 1.5, "3", True, None])
def test_bad_counts(spark, n):
    with pytest.raises(ValueError):
        ts.with_slice(frame(spark, [0]), n)
