import datetime as dt

import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.plans.temporary import shared_folder, staged, temp_database, temp_tables


def rows(spark):
    return spark.sql(
        """SELECT TIMESTAMP_NTZ'2001-01-01' + make_interval(0, 0, 0, CAST(id AS INT)) AS `$timestamp`,
                  id, array(id) AS list, NULL AS nothing, 5 AS `$hidden` FROM range(40)"""
    )


def test_materialized_rows_are_the_same(spark):
    kept = ts.materialize(rows(spark))
    assert kept.columns == ["$timestamp", "id", "list", "nothing"]
    expected = rows(spark).select("$timestamp", "id", "list", F.lit(None).cast("string").alias("nothing"))
    assert kept.exceptAll(expected).count() == expected.exceptAll(kept).count() == 0


def test_result_runs_once(spark):
    noisy = rows(spark).withColumn("r", F.rand())
    kept = ts.materialize(noisy)
    assert kept.agg(F.sum("r")).first() == kept.agg(F.sum("r")).first()


def test_needs_an_axis_and_leaves_nothing_behind(spark):
    before = temp_tables(spark)
    with pytest.raises(ValueError):
        ts.materialize(spark.range(3))
    with pytest.raises(Exception, match="broken"):
        ts.materialize(rows(spark).withColumn("x", F.raise_error(F.lit("broken")).cast("string")))
    assert temp_tables(spark) == before


def test_files_lie_in_the_shared_folder(spark):
    kept = ts.materialize(rows(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(f"{shared_folder(spark)}/{temp_database(spark)}/" in f for f in kept.inputFiles())


def test_names_sort_by_creation(spark):
    before = set(temp_tables(spark))
    ts.materialize(rows(spark))
    first = set(temp_tables(spark)) - before
    ts.materialize(rows(spark))
    second = set(temp_tables(spark)) - before - first
    assert first.pop() < second.pop()


def test_expiry_counts_from_creation(spark):
    before = set(temp_tables(spark))
    short = ts.materialize(rows(spark), ttl="1h")  # rows are from 2001, the table is not
    (short_name,) = set(temp_tables(spark)) - before
    ts.materialize(rows(spark), ttl="3d")
    (long_name,) = set(temp_tables(spark)) - before - {short_name}
    now = dt.datetime.now(dt.timezone.utc)
    assert not {short_name, long_name} & set(ts.expire_temp(spark))
    assert short.count() == 40
    dropped = ts.expire_temp(spark, now + dt.timedelta(hours=2))
    assert short_name in dropped and long_name not in dropped
    assert short_name not in temp_tables(spark)
    assert long_name in ts.expire_temp(spark, now + dt.timedelta(days=4))


def test_staged_rows_go_away(spark):
    before = temp_tables(spark)
    with staged(rows(spark).select("id")) as batch:
        assert batch.count() == 40 and len(temp_tables(spark)) == len(before) + 1
    assert temp_tables(spark) == before


def test_cluster_without_shared_folder_is_an_error(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
