import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.functions import instant_micros, shard_of, width_micros
from tickshard.operators.axis import merged_ranges

LO, HI = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
MICRO = dt.timedelta(microseconds=1)


def stamps(spark, *moments):
    return spark.createDataFrame([(m,) for m in moments], "`$timestamp` timestamp_ntz")


def test_range_includes_start_and_leaves_out_end(spark):
    df = stamps(spark, LO - MICRO, LO, HI - MICRO, HI)
    kept = [r[0] for r in ts.time_range(df, LO, HI).collect()]
    assert sorted(kept) == [LO, HI - MICRO]
    assert ts.time_range(df, HI, LO).count() == 0


def test_bound_finer_than_a_microsecond_rounds_up():
    assert instant_micros(np.datetime64("1970-01-01T00:00:00.000001001")) == 2
    assert instant_micros(pd.Timestamp("1969-12-31T23:59:59.999999999")) == 0
    assert instant_micros("1970-01-01T01:00:00+01:00") == 0


def test_widths():
    assert width_micros("1h") == width_micros(dt.timedelta(hours=1)) == 3_600_000_000
    assert width_micros("3 us") == 3
    for bad in ("1 fortnight", "h", "", "0d", 0, -5):
        with pytest.raises(ValueError):
            width_micros(bad)
    with pytest.raises(TypeError):
        width_micros(1.5)


def test_ranges_merge():
    merged = merged_ranges([("1970-01-03", "1970-01-04"), ("1970-01-01", "1970-01-02"),
                            ("1970-01-02", "1970-01-02T12:00"), ("1970-01-05", "1970-01-05")])
    day = 86_400_000_000
    assert merged == [(0, day + day // 2), (2 * day, 3 * day)]


def test_shards_floor_before_1970(spark):
    df = stamps(spark, dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
                dt.datetime(1969, 12, 31), dt.datetime(1969, 12, 30, 23))
    rows = df.select("$timestamp", shard_of("$timestamp", width_micros("1d")).alias("s")).collect()
    assert [r.s for r in rows] == [-1, 0, -1, -2]


def test_axis_from_text_zoned_and_date(spark):
    text = spark.createDataFrame([("2024-01-01 10:00:00.5",), ("2024-01-01T12:00:00+02:00",), (None,)], "t string")
    rows = [r[0] for r in ts.normalize_axis(text, "t").collect()]
    assert rows == [dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 1, 10), None]
    dates = spark.createDataFrame([(dt.date(2024, 1, 1),)], "`$timestamp` date")
    assert ts.normalize_axis(dates).first()[0] == LO


def test_axis_text_that_is_no_time_fails_the_job(spark):
    df = ts.normalize_axis(spark.createDataFrame([("soon",)], "t string"), "t")
    with pytest.raises(Exception, match="not a timestamp: soon"):
        df.collect()


def test_missing_axis_or_wrong_type(spark):
    with pytest.raises(ValueError, match="no '\\$timestamp'"):
        ts.normalize_axis(spark.range(3))
    with pytest.raises(TypeError):
        ts.normalize_axis(spark.range(3), "id")
    both = stamps(spark, LO).withColumn("other", F.col("$timestamp"))
    with pytest.raises(ValueError, match="both"):
        ts.normalize_axis(both, "other")


def test_other_session_zones(spark):
    """Buckets do not depend on the zone; what would is refused."""
    df = stamps(spark, LO, dt.datetime(2024, 3, 31, 2, 30), dt.datetime(1969, 12, 31, 23, 59))
    expected = {(LO,), (dt.datetime(2024, 3, 31, 2),), (dt.datetime(1969, 12, 31, 23),)}
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        buckets = ts.bucket_count(df, "1h", "$timestamp").select("$timestamp").collect()
        with pytest.raises(ValueError, match="UTC"):
            ts.with_slice(df, 3)
        with pytest.raises(ValueError, match="UTC"):
            ts.write_dataframe(df, "never_made").compute()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert set(map(tuple, buckets)) == expected


def test_sessions_whose_timestamps_have_no_zone(spark):
    spark.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    try:
        text = spark.createDataFrame([("2024-01-01 10:30:00",)], "t string")
        df = ts.bucket_count(ts.normalize_axis(text, "t").withColumn("x", F.lit(1)), "1h", "x")
        assert tuple(df.first()) == (dt.datetime(2024, 1, 1, 10), 1)
    finally:
        spark.conf.unset("spark.sql.timestampType")
