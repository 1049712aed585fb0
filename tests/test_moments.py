"""Statistics from the moments that are stored with shards."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.plans import moments
from tickshard.plans.snapshots import Stored

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)
UPSERT = {"deduplicate": ["k"], "deduplication_mode": "upsert"}
SCHEMA = "`$timestamp` timestamp_ntz, k bigint, x double, `n of` int"


def rows(spark, numbers, shift=0.0):
    held = [
        (START + i * DAY / 4, i, None if i % 7 == 3 else math.nan if i % 11 == 5 else i * 1.5 + shift,
         None if i % 5 == 0 else i * i)
        for i in numbers
    ]
    return spark.createDataFrame(held, SCHEMA)


def same(found, scanned):
    (a,), (b,) = found.collect(), scanned.collect()
    assert found.columns == scanned.columns
    assert [f.dataType for f in found.schema] == [f.dataType for f in scanned.schema]
    for x, y in zip(a, b):
        assert (x is None) == (y is None)
        assert x is None or float(x) == pytest.approx(float(y), rel=1e-12, nan_ok=True)


def check(spark, table, ranges=None):
    """Moments say what a scan says."""
    scan = ts.read_table(spark, table)
    if ranges is not None:
        scan = ts.read_ranges(spark, table=table, ranges=ranges)
    same(ts.stored_stats(spark, table, "x", "n of", ranges=ranges), ts.global_stats(scan, "x", "n of"))


@pytest.fixture(params=["0s", "1h"])
def grace(spark, request):
    spark.conf.set("tickshard.grace", request.param)
    yield
    spark.conf.unset("tickshard.grace")


def test_moments_follow_every_kind_of_write(spark, table_name, grace):
    ts.write_dataframe(rows(spark, range(40)), table_name).compute()
    ts.measure_columns(spark, table_name, ["x"])
    ts.measure_columns(spark, table_name, ["n of", "x"])  # one more, for what is stored as well
    check(spark, table_name)
    writes = [
        (rows(spark, range(30, 50)), {}),
        (rows(spark, range(8, 17), 100.0), {"push_mode": "truncate"}),
        (rows(spark, [1, 18, 33, 70], 1e3), UPSERT),
        (rows(spark, [2, 71]), {"deduplicate": ["k"]}),
        (rows(spark, range(0, 4), 7.0), {"push_mode": "truncate"}),
        (rows(spark, []), {}),
    ]
    for frame, options in writes:
        ts.write_dataframe(frame, table_name, **options).compute()
        check(spark, table_name)
    ts.compact_table(spark, table_name)
    check(spark, table_name)
    ts.remove_replaced(spark, table_name)
    check(spark, table_name)
    at = lambda days: START + days * DAY
    for ranges in (
        [],
        [(at(1), at(9))],
        [(at(0.5), at(0.75))],
        [(at(0.25), at(3.5)), (at(3.75), at(4)), (at(17), at(40))],
        [(at(-400), at(400))],
    ):
        check(spark, table_name, ranges)


def test_part_of_a_generation_removed(spark, table_name, grace):
    """A removed shard's moments stay in the folder of its write and no longer count."""
    ts.write_dataframe(rows(spark, range(40)), table_name).compute()
    ts.measure_columns(spark, table_name, ["x", "n of"])
    for i in range(3):
        ts.write_dataframe(rows(spark, [5, 9], float(i)), table_name, **UPSERT).compute()
        check(spark, table_name)


def test_no_row_is_read(spark, table_name):
    ts.write_dataframe(rows(spark, range(40)), table_name).compute()
    ts.measure_columns(spark, table_name, ["x"])
    files = ts.stored_stats(spark, table_name, "x").inputFiles()
    assert files and all(f"/{moments.FOLDER}/" in f for f in files)
    part = ts.stored_stats(spark, table_name, "x", ranges=[(START + DAY / 2, START + 6 * DAY)])
    read = {f.rsplit("shard=", 1)[1].split("/")[0] for f in part.inputFiles() if moments.FOLDER not in f}
    assert read == {str((START - dt.datetime(1970, 1, 1)).days)}
    frame = ts.read_table(spark, table_name)
    same(
        ts.with_global_stats(frame, "x", stats=ts.stored_stats(spark, table_name, "x")).limit(1).select("sum_x", "std_x"),
        ts.global_stats(frame, "x").select("sum_x", "std_x"),
    )


def test_a_measuring_that_failed_counts_once(spark, table_name, monkeypatch):
    ts.write_dataframe(rows(spark, range(20)), table_name).compute()
    measure = Stored._measure

    def overtaken(self, gen, columns):
        measure(self, gen, columns)
        monkeypatch.setattr(Stored, "_measure", measure)
        ts.write_dataframe(rows(spark, [90]), table_name).compute()

    monkeypatch.setattr(Stored, "_measure", overtaken)
    with pytest.raises(ts.ConcurrentWriteError):
        ts.measure_columns(spark, table_name, ["x", "n of"])
    with pytest.raises(ValueError, match="not measured"):
        ts.stored_stats(spark, table_name, "x")
    ts.measure_columns(spark, table_name, ["x", "n of"])
    check(spark, table_name)


def test_an_append_that_others_overtook(spark, table_name, monkeypatch):
    """Its rows go to a later generation; those of the first one do not count."""
    ts.write_dataframe(rows(spark, range(12)), table_name).compute()
    ts.measure_columns(spark, table_name, ["x", "n of"])
    insert, other = Stored._insert, [rows(spark, [1, 6], 50.0)]

    def slow(self, gen, frame, cluster):
        insert(self, gen, frame, cluster)
        if other:
            ts.write_dataframe(other.pop(), table_name, push_mode="truncate").compute()

    monkeypatch.setattr(Stored, "_insert", slow)
    ts.write_dataframe(rows(spark, [2, 30], 9.0), table_name).compute()
    assert ts.read_table(spark, table_name).where("k IN (2, 30)").count() == 2
    check(spark, table_name)


def test_values_far_from_zero_and_beyond_64_bits(spark, table_name):
    held = [(START + i * DAY, i, 1e9 + i % 3, 2**62 + i) for i in range(30)]
    frame = spark.createDataFrame(held, "`$timestamp` timestamp_ntz, k bigint, x double, w bigint")
    ts.write_dataframe(frame, table_name).compute()
    ts.measure_columns(spark, table_name, ["x", "w"])
    row = ts.stored_stats(spark, table_name, "x", "w").first()
    assert int(row.sum_w) == sum(2**62 + i for i in range(30))
    assert row.std_x == pytest.approx(0.830454798537, rel=1e-9)


def test_tables_without_rows_or_values(spark, table_name):
    ts.write_dataframe(rows(spark, []), table_name).compute()
    ts.measure_columns(spark, table_name, ["x", "n of"])
    check(spark, table_name)
    ts.write_dataframe(rows(spark, [3]).withColumn("n of", F.lit(None).cast("int")), table_name).compute()
    check(spark, table_name)  # a row with no value
    ts.write_dataframe(rows(spark, [1]), table_name).compute()
    check(spark, table_name)  # one value has no deviation
    inf = rows(spark, [2, 4]).withColumn("x", F.lit(math.inf))
    ts.write_dataframe(inf, table_name).compute()
    check(spark, table_name)


def test_what_can_be_measured(spark, table_name):
    ts.write_dataframe(rows(spark, [1]).withColumn("s", F.lit("a")), table_name).compute()
    for wrong in (["s"], ["$timestamp"], ["$shard"], ["y"], []):
        with pytest.raises(ValueError):
            ts.measure_columns(spark, table_name, wrong)
