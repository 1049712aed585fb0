import datetime as dt

from pyspark.sql import functions as F

import tickshard as ts

NAN = float("nan")


def test_bucket_counts_skip_missing_and_empty_buckets(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 0, 59, 59, 999999), 1.0, "a"),
        (dt.datetime(2024, 1, 1, 1), NAN, None),
        (dt.datetime(2024, 1, 1, 1, 30), None, "b"),
        (dt.datetime(2024, 1, 1, 5), 2.0, None),
        (None, 3.0, "c"),
    ]
    df = ts.nan_to_null(spark.createDataFrame(rows, "`$timestamp` timestamp_ntz, v double, s string"))
    got = ts.bucket_count(df, "1h", "v", "s").orderBy("$timestamp").collect()
    assert [tuple(r) for r in got] == [
        (dt.datetime(2024, 1, 1, 0), 1, 1),
        (dt.datetime(2024, 1, 1, 1), 0, 1),
        (dt.datetime(2024, 1, 1, 5), 1, 0),
    ]
    assert got[0].asDict().keys() == {"$timestamp", "count(v)", "count(s)"}


def test_buckets_floor_before_1970(spark):
    rows = [(dt.datetime(1969, 12, 31, 23),), (dt.datetime(1970, 1, 1),)]
    df = spark.createDataFrame(rows, "`$timestamp` timestamp_ntz")
    got = ts.bucket_agg(df, "7h", F.count("*").alias("n")).orderBy("$timestamp").collect()
    assert [tuple(r) for r in got] == [(dt.datetime(1969, 12, 31, 17), 1), (dt.datetime(1970, 1, 1), 1)]


def test_global_stats_skip_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (3.0,)], "x double")
    row = ts.global_stats(df, "x").first()
    assert (row.sum_x, row.mean_x) == (4.0, 2.0) and abs(row.std_x - 2**0.5) < 1e-12
    rows = ts.with_global_stats(df, "x").collect()
    assert len(rows) == 4 and {(r.sum_x, r.mean_x) for r in rows} == {(4.0, 2.0)}


def test_global_stats_over_nothing(spark):
    df = spark.createDataFrame([(None,), (NAN,)], "x double")
    assert ts.global_stats(df, "x").first() == (0.0, None, None)
    one = spark.createDataFrame([(5,)], "x bigint")
    assert ts.global_stats(one, "x").first() == (5, 5.0, None)
    assert ts.with_global_stats(one.limit(0), "x").count() == 0


def test_filled_buckets(spark, monkeypatch):
    """Against brute force, with stretches of four buckets, across 1970 and long gaps."""
    import datetime as dt
    import random

    from tickshard.operators import buckets

    monkeypatch.setattr(buckets, "STRETCH", 4)
    rng = random.Random(2)
    start = dt.datetime(1969, 12, 31, 20)
    rows = [(start + dt.timedelta(minutes=rng.choice([0, 30, 70, 600]) + rng.randrange(40)),
             rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3])) for _ in range(60)]
    rows += [(None, "a", 9), (dt.datetime(1970, 1, 3, 5, 5), "b", None), (dt.datetime(1970, 1, 9), "c", None)]
    df = spark.createDataFrame(rows, "`$timestamp` timestamp_ntz, k string, v bigint")
    for on in (["k"], []):
        got = ts.bucket_filled(df, "1h", "v", on=on, carry={"last v": "v"}).collect()
        wanted = set()
        for key in {k for t, k, _ in rows} if on else {None}:
            mine = [(t, v) for t, k, v in rows if t is not None and (not on or k == key)]
            hour = lambda t: t.replace(minute=0)
            at, end = hour(min(t for t, _ in mine)) if mine else None, max(t for t, _ in mine)
            while at <= end:
                n = sum(hour(t) == at and v is not None for t, v in mine)
                before = [(t, v) for t, v in mine if hour(t) <= at and v is not None]
                wanted.add((*([key] if on else []), at, n, max(before)[1] if before else None))
                at += dt.timedelta(hours=1)
        assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)
    assert ts.bucket_filled(df.limit(0), "1h", "v", on=["k"]).count() == 0
    assert ts.bucket_filled(df.limit(0), "1h", "v").count() == 0
