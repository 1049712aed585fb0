import datetime as dt

import pytest
from pyspark.sql import functions as F

import tickshard as ts

DDL = "at timestamp_ntz, id bigint, v double"
START = dt.datetime(2024, 1, 1)


def put(spark, folder, *ids, value=0.0):
    rows = [(START + dt.timedelta(hours=i), i, value) for i in ids]
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, folder, checkpoint, table, **options):
    stream = spark.readStream.schema(DDL).parquet(str(folder))
    query = ts.write_stream(
        stream, table, checkpoint=str(checkpoint), axis="at", available_now=True, **options
    )
    query.awaitTermination()


def ids(spark, table):
    return sorted(r.id for r in ts.read_table(spark, table).collect())


def test_restart_adds_no_row_twice(spark, table_name, tmp_path):
    put(spark, tmp_path / "in", 0, 1, 30)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    assert ids(spark, table_name) == [0, 1, 30]
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    put(spark, tmp_path / "in", 2, 31)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    assert ids(spark, table_name) == [0, 1, 2, 30, 31]
    assert ts.read_table(spark, table_name).columns == ["$timestamp", "id", "v"]


def test_batch_written_but_not_noted_is_not_written_again(spark, table_name, tmp_path):
    put(spark, tmp_path / "in", 0, 1)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    put(spark, tmp_path / "in", 2)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    # A driver lost after the write and before the note leaves no commit for batch 1.
    for note in (tmp_path / "ck" / "commits").glob("*1*"):
        note.unlink()
    put(spark, tmp_path / "in", 3)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name)
    assert ids(spark, table_name) == [0, 1, 2, 3]


def test_two_streams_and_a_batch_write_share_a_table(spark, table_name, tmp_path):
    put(spark, tmp_path / "a", 1)
    put(spark, tmp_path / "b", 2)
    run(spark, tmp_path / "a", tmp_path / "ck_a", table_name)
    run(spark, tmp_path / "b", tmp_path / "ck_b", table_name)
    more = spark.createDataFrame([(START, 9, None)], DDL)
    ts.write_dataframe(more, table_name, axis="at").compute()
    changed = more.withColumn("v", F.lit(5.0))
    ts.write_dataframe(changed, table_name, axis="at", deduplicate=["id"], deduplication_mode="upsert").compute()
    assert ids(spark, table_name) == [1, 2, 9]
    assert ts.read_table(spark, table_name).where("id = 9").first().v == 5.0
    ts.write_dataframe(more, table_name, axis="at", push_mode="truncate").compute()
    assert ids(spark, table_name) == [1, 2, 9]


def test_upserting_and_dropping_streams(spark, table_name, tmp_path):
    options = {"deduplicate": ["id"], "deduplication_mode": "upsert"}
    put(spark, tmp_path / "in", 1, 2)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name, **options)
    put(spark, tmp_path / "in", 2, 3, value=4.0)
    run(spark, tmp_path / "in", tmp_path / "ck", table_name, **options)
    rows = {r.id: r.v for r in ts.read_table(spark, table_name).collect()}
    assert rows == {1: 0.0, 2: 4.0, 3: 4.0}
    put(spark, tmp_path / "more", 3, 5, 5, value=7.0)
    run(spark, tmp_path / "more", tmp_path / "ck2", table_name, deduplicate=["id"])
    assert ids(spark, table_name) == [1, 2, 3, 5]


def test_bad_mode(spark, tmp_path):
    stream = spark.readStream.schema(DDL).parquet(str(tmp_path))
    with pytest.raises(ValueError):
        ts.write_stream(stream, "t", checkpoint=str(tmp_path / "ck"), push_mode="slow")
