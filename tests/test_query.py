import datetime as dt

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tickshard as ts

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def stored(spark):
    df = spark.range(300).select(
        F.timestamp_micros(F.col("id") * 3_600_000_000 + 1_704_067_200_000_000)
        .cast("timestamp_ntz").alias("$timestamp"),
        F.col("id").alias("x"),
        (F.col("id") % 7).cast("double").alias("y"),
    )
    ts.write_dataframe(df, "stored_for_queries").compute()
    return "stored_for_queries"


def jobs(spark, action):
    """How many Spark jobs *action* starts."""
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize(
    "text",
    [
        # would act at once
        "CREATE TABLE made_by_query AS SELECT id FROM range(3)",
        "TRUNCATE TABLE stored_for_queries",
        "DROP TABLE IF EXISTS stored_for_queries PURGE",
        "INSERT OVERWRITE stored_for_queries SELECT * FROM stored_for_queries",
        "ALTER TABLE stored_for_queries RENAME TO made_by_query",
        "DELETE FROM stored_for_queries WHERE x > 10",
        # would read metadata
        "DESCRIBE TABLE EXTENDED stored_for_queries",
        "SHOW PARTITIONS stored_for_queries",
        "SHOW DATABASES LIKE 't*'",
        "WITH a AS (SELECT 1) SELECT * FROM a",
        "(SELECT 1)",
        "-- SELECT\nSELECT 1",
        "VALUES (1)",
        "SELECTED",
        "",
    ],
)
def test_only_select(spark, stored, text):
    with pytest.raises(ValueError, match="only SELECT"):
        ts.query(spark, text)
    with pytest.raises(ValueError, match="only SELECT"):
        ts.result_schema(spark, text)
    assert spark.catalog.tableExists(stored) and not spark.catalog.tableExists("made_by_query")


@pytest.mark.parametrize("text", ["select 1 AS a", "  \n SeLeCt\t1 AS a", "SELECT\n1 AS a"])
def test_select_in_any_case(spark, text):
    assert ts.query(spark, text).first() == (1,)


def test_nothing_runs_before_an_action(spark, stored):
    df, started = jobs(spark, lambda: ts.query(spark, f'SELECT * FROM "{stored}"'))
    assert started == 0
    assert df.columns == ["$timestamp", "x", "y"]
    _, started = jobs(spark, df.count)
    assert started > 0


def test_schema_without_a_job(spark, stored):
    text = f"SELECT `$timestamp`, x AS a, y / 2 AS b, NULL AS c, '$' AS `$d` FROM {stored}"
    schema, started = jobs(spark, lambda: ts.result_schema(spark, text))
    assert started == 0
    assert [f.name for f in schema] == ["$timestamp", "a", "b", "c"]
    assert ts.query(spark, text).schema == schema


@pytest.mark.parametrize("part", [1, 0.5, 0.25])
@pytest.mark.parametrize("alias", [False, True])
def test_columns_and_ranges(spark, stored, part, alias):
    last = START + dt.timedelta(hours=int(299 * part))
    source = ts.read_ranges(spark, table=stored, ranges=[(START, last)])
    names = "x AS x_alias, y AS y_alias" if alias else "x, y"
    df = ts.query(spark, f"SELECT `$timestamp`, {names} FROM {{t}}", views={"t": source})
    assert df.columns == ["$timestamp"] + [f"{c}_alias" if alias else c for c in "xy"]
    assert sorted(r[1] for r in df.collect()) == list(range(int(299 * part)))


def test_declared_schema(spark, stored):
    schema = T.StructType.fromDDL("y double, `$timestamp` timestamp_ntz, more string")
    df = ts.query(spark, f"SELECT `$timestamp`, y FROM {stored}", schema=schema)
    assert df.columns == ["y", "$timestamp", "more"] and df.where("more IS NULL").count() == 300


@pytest.mark.parametrize("materialize", [False, True])
def test_partitions_are_slices(spark, stored, materialize):
    text = f"SELECT *, sum(x) OVER (ORDER BY `$timestamp`) AS running FROM {stored}"
    df = ts.query(spark, text, npartitions=7, materialize=materialize)
    assert df.rdd.getNumPartitions() == 7
    rows = df.select(F.spark_partition_id().alias("p"), "x", "running").collect()
    assert [r.x for r in rows] == list(range(300))
    span = 299 * 3_600_000_000 + 1
    assert [r.p for r in rows] == [((i * 3_600_000_000 + 1) * 7 - 1) // span for i in range(300)]
    assert all(r.running == r.x * (r.x + 1) // 2 for r in rows)


def test_same_columns_for_any_partition_count(spark, stored):
    text = f"SELECT *, '{stored}' AS `$table` FROM {stored}"
    shapes = {tuple(ts.query(spark, text, npartitions=n).columns) for n in (1, 2)}
    assert shapes == {("$timestamp", "x", "y")}


def test_empty_result_in_partitions(spark, stored):
    df = ts.query(spark, f"SELECT * FROM {stored} WHERE x < 0", npartitions=4, materialize=True)
    assert df.count() == 0 and df.columns == ["$timestamp", "x", "y"]


@pytest.mark.parametrize("n", [0, -3, 2.0, None])
def test_bad_partition_counts(spark, stored, n):
    with pytest.raises(ValueError):
        ts.query(spark, f"SELECT * FROM {stored}", npartitions=n)


def test_partitions_need_an_axis(spark, stored):
    with pytest.raises(ValueError, match="timestamp"):
        ts.query(spark, f"SELECT x FROM {stored}", npartitions=2)
    assert ts.query(spark, f"SELECT count(*) AS n FROM {stored}").first() == (300,)


def test_persist(spark, stored):
    df = ts.query(spark, f"SELECT * FROM {stored}", persist=True)
    assert df.storageLevel == StorageLevel.MEMORY_AND_DISK_DESER or df.is_cached
    assert df.count() == 300
    df.unpersist()


def test_ranges(spark, stored):
    at = lambda h: START + dt.timedelta(hours=h)
    df = ts.read_ranges(spark, table=stored, column_names=["x"],
                        ranges=[(at(5), at(10)), (at(8), at(12)), (at(40), at(40)), (at(290), at(999))])
    assert df.columns == ["$timestamp", "x"]
    assert sorted(r.x for r in df.collect()) == [*range(5, 12), *range(290, 300)]
    assert ts.read_ranges(spark, table=stored, ranges=[]).count() == 0
    with pytest.raises(TypeError):
        ts.read_ranges(spark, table=stored)


def test_read_request(spark, stored):
    request = {"table": stored, "ranges": [(START, START + dt.timedelta(hours=3))], "column_names": ["y", "x"]}
    df = ts.read_request(spark, request)
    assert df.columns == ["$timestamp", "y", "x"] and df.count() == 3
    for key in request:
        with pytest.raises(KeyError, match=key):
            ts.read_request(spark, {k: v for k, v in request.items() if k != key})


@pytest.mark.parametrize("n", [1, 2, 9, 40])
def test_slices_of_a_table_are_range_reads(spark, stored, n):
    df = ts.read_slices(spark, table=stored, npartitions=n, column_names=["x"], scans=True)
    assert df.columns == ["$timestamp", "x"] and df.rdd.getNumPartitions() == n
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.select(F.spark_partition_id().alias("p"), "x").collect()
    assert [r.x for r in rows] == list(range(300))
    span = 299 * 3_600_000_000 + 1
    assert [r.p for r in rows] == [((i * 3_600_000_000 + 1) * n - 1) // span for i in range(300)]


def test_slices_of_a_table_with_gaps_and_hot_slices(spark, table_name):
    hours = [0] * 3000 + [1, 2, 5000]
    df = spark.createDataFrame([(START + dt.timedelta(hours=h), i) for i, h in enumerate(hours)],
                               "`$timestamp` timestamp_ntz, id bigint").repartition(8)
    ts.write_dataframe(df, table_name, cluster=False).compute()
    even = ts.read_slices(spark, table=table_name, npartitions=10, scans=True)
    sizes = {r.p: r["count"] for r in even.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    assert even.rdd.getNumPartitions() == 10 and sizes == {0: 3002, 9: 1}
    split = ts.read_slices(spark, table=table_name, npartitions=10, split_rows=1000, scans=True)
    assert split.rdd.getNumPartitions() == 9 + 4
    assert split.exceptAll(df).count() == df.exceptAll(split).count() == 0


def test_slices_of_a_small_table_are_cut_by_a_shuffle(spark, stored):
    df = ts.read_slices(spark, table=stored, npartitions=6)
    assert df.rdd.getNumPartitions() == 6 and [r.x for r in df.collect()] == list(range(300))


def test_materialized_rows_without_a_time_are_kept(spark, stored):
    text = f"""SELECT CASE WHEN x % 3 > 0 THEN `$timestamp` END AS `$timestamp`, x FROM {stored}"""
    df = ts.query(spark, text, npartitions=4, materialize=True)
    assert sorted(r.x for r in df.collect()) == list(range(300))
