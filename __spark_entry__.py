"""

Queries that write make a fresh table in the shared folder on every call, run the
write and return what the table then holds.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tickshard as ts
from tickshard.names import AXIS
from tickshard.operators import coerce, stored_schema
from tickshard.plans.temporary import shared_folder, temp_name
from tickshard.session import configure

Query = Callable[[SparkSession, str], DataFrame]

# The corpus operators are a part that may be left out.
try:
    import corpus_pipeline
    from tickshard.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tickshard.llm"):
        raise
    corpus_pipeline = corpus_queries = None


def _corpus() -> dict[str, Query]:
    if corpus_queries is None:
        return {}
    return {**corpus_queries.QUERIES, "pipeline": corpus_pipeline.run}


def _table(spark: SparkSession, sf_dir: str, name: str, axis: str | None = None) -> DataFrame:
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df if axis is None else ts.normalize_axis(df, axis)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events", "ts")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders", "o_orderdate")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem", "l_shipdate")


def _from(df: DataFrame, moment: str) -> DataFrame:
    return df.where(F.col(AXIS) >= F.lit(moment).cast("timestamp_ntz"))


def _until(df: DataFrame, moment: str) -> DataFrame:
    return df.where(F.col(AXIS) < F.lit(moment).cast("timestamp_ntz"))


def _gappy(events: DataFrame) -> DataFrame:
    """Events whose value is NULL for clicks and NaN for errors, and without props for views."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit("NaN").cast("double")).when(
        kind != "click", F.col("value")
    )
    return events.withColumns({"value": value, "props": F.when(kind != "view", F.col("props"))})


_GAPPY = """
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS value,
           CASE WHEN event_type <> 'view' THEN props END AS props
    FROM events"""

_EVENT_COLUMNS = 'ts AS "$timestamp", event_id, user_id, event_type, value, props'


# -- selection ---------------------------------------------------------------------


def select_star(spark, sf_dir):
    return ts.query(spark, "SELECT * FROM {events}", views={"events": _events(spark, sf_dir)})


def select_star_range(spark, sf_dir):
    return ts.time_range(_events(spark, sf_dir), "2024-01-08", "2024-01-15T12:30:00.000001")


def select_alias(spark, sf_dir):
    sql = "SELECT `$timestamp`, value AS value_alias, props AS props_alias FROM {events}"
    return ts.query(spark, sql, views={"events": _events(spark, sf_dir)})


def select_alias_range(spark, sf_dir):
    events = ts.time_range(_events(spark, sf_dir), "2024-01-01", "2024-01-08")
    sql = "SELECT `$timestamp`, value AS value_alias FROM {events}"
    return ts.query(spark, sql, views={"events": events})


def select_hides_internal(spark, sf_dir):
    sql = "SELECT *, event_type AS `$table`, event_id AS `$row` FROM {events}"
    return ts.query(spark, sql, views={"events": _events(spark, sf_dir)})


# -- typing ------------------------------------------------------------------------


def declared_schema(spark, sf_dir):
    """Reordered, widened, one column that is not there, one all-missing float."""
    schema = T.StructType(
        [
            T.StructField("l_linenumber", T.LongType()),
            T.StructField(AXIS, T.TimestampNTZType()),
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("comment", T.StringType()),
            T.StructField("flag", T.StringType()),
        ]
    )
    sql = """SELECT `$timestamp`, l_orderkey, l_linenumber,
                    CAST('NaN' AS DOUBLE) AS flag FROM {lineitem}"""
    return ts.query(spark, sql, views={"lineitem": _lineitem(spark, sf_dir)}, schema=schema)


def axis_from_text(spark, sf_dir):
    texts = _events(spark, sf_dir).select(F.col(AXIS).cast("string").alias("moment"), "event_id")
    return ts.normalize_axis(texts, "moment")


def axis_from_zoned(spark, sf_dir):
    zoned = _events(spark, sf_dir).select(F.col(AXIS).cast("timestamp").alias("at"), "event_id")
    return ts.normalize_axis(zoned, "at")


def coerced_types(spark, sf_dir):
    """Small integers and floats widen; numbers in texts and times in texts are read."""
    df = _lineitem(spark, sf_dir).select(
        AXIS,
        "l_orderkey",
        F.col("l_linenumber").cast("smallint").alias("line"),
        F.col("l_quantity").cast("float").alias("quantity"),
        F.col("l_suppkey").cast("string").alias("supplier"),
        F.col(AXIS).cast("string").alias("shipped"),
        F.col("l_partkey").cast("double").alias("part"),
    )
    wanted = stored_schema(df.schema)
    changed = {"supplier": T.LongType(), "shipped": T.TimestampNTZType(), "part": T.LongType()}
    target = T.StructType([T.StructField(f.name, changed.get(f.name, f.dataType)) for f in wanted])
    return coerce(df, target)


def missing_values(spark, sf_dir):
    return ts.nan_to_null(_gappy(_events(spark, sf_dir)))


# -- aggregates --------------------------------------------------------------------


def _bucket_counts(table: str, axis: str, width: str, *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counted = ts.bucket_count(_table(spark, sf_dir, table, axis), width, *columns)
        return counted.withColumnsRenamed({f"count({c})": f"count_{c}" for c in columns})

    return run


def _bucket_counts_sql(table: str, axis: str, interval: str, *columns: str) -> str:
    counts = ", ".join(f"count({c}) AS count_{c}" for c in columns)
    bucket = f"time_bucket(INTERVAL '{interval}', {axis}, TIMESTAMP '1970-01-01')"
    return f'SELECT {bucket} AS "$timestamp", {counts} FROM {table} GROUP BY 1'


def bucket_count_missing(spark, sf_dir):
    counted = ts.bucket_count(missing_values(spark, sf_dir), "1h", "value", "props", "event_id")
    return counted.toDF(AXIS, "count_value", "count_props", "count_event_id")


def bucket_count_sql(spark, sf_dir):
    """The same bucket written in SQL, for users who stay with one text."""
    sql = """SELECT window.start AS `$timestamp`, count(value) AS count_value
             FROM {events} GROUP BY window(`$timestamp`, '1 hour')"""
    return ts.query(spark, sql, views={"events": missing_values(spark, sf_dir)})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def global_stats(spark, sf_dir):
    stats = ts.global_stats(_lineitem(spark, sf_dir), "l_extendedprice", "l_quantity")
    return _rounded(stats, *[c for c in stats.columns])


def global_stats_broadcast(spark, sf_dir):
    """Sum, mean and deviation of a column with NULL and NaN, on every row."""
    extended = ts.with_global_stats(_gappy(_events(spark, sf_dir)), "value")
    kept = extended.select(AXIS, "event_id", "sum_value", "mean_value", "std_value")
    return _rounded(kept, "sum_value", "mean_value", "std_value")


def global_stats_broadcast_integers(spark, sf_dir):
    extended = ts.with_global_stats(_lineitem(spark, sf_dir), "l_partkey")
    total = F.col("sum_l_partkey").cast("bigint").alias("sum_l_partkey")
    kept = extended.select(
        "l_orderkey", "l_linenumber", total, "mean_l_partkey", "std_l_partkey"
    )
    return _rounded(kept, "mean_l_partkey", "std_l_partkey")


def global_stats_large(spark, sf_dir):
    """A sum far beyond 64 bits, as text."""
    large = _lineitem(spark, sf_dir).select(
        AXIS, (F.col("l_partkey") * 10**12 + F.col("l_orderkey") * 10**11).alias("large")
    )
    return ts.global_stats(large, "large").select(F.col("sum_large").cast("string").alias("sum_large"))


# -- slices ------------------------------------------------------------------------


def slice_bounds(spark, sf_dir):
    return ts.slice_bounds(_events(spark, sf_dir), 7)


def _slice_counts(table: str, axis: str, n: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sliced = ts.with_slice(_table(spark, sf_dir, table, axis), n, "slice")
        return sliced.groupBy("slice").agg(F.count("*").alias("rows"))

    return run


def _slice_sql(axis: str, n: int, rows: str) -> str:
    return f"""
        SELECT r.*, CAST(((epoch_us({axis}) - lo + 1)::HUGEINT * {n} - 1) // (hi - lo + 1)
                         AS INTEGER) AS slice
        FROM ({rows}) r,
             (SELECT min(epoch_us({axis})) AS lo, max(epoch_us({axis})) AS hi FROM ({rows}) s) b"""


def _slice_counts_sql(table: str, axis: str, n: int) -> str:
    sliced = _slice_sql(axis, n, f"SELECT {axis} FROM {table}")
    return f"SELECT slice, count(*) AS rows FROM ({sliced}) GROUP BY slice"


def sliced_partitions(spark, sf_dir):
    """Rows per Spark partition of a partitioned read, with each partition's ends."""
    sql = "SELECT `$timestamp`, o_orderkey FROM {orders}"
    read = ts.query(spark, sql, views={"orders": _orders(spark, sf_dir)}, npartitions=8)
    return read.groupBy(F.spark_partition_id().alias("slice")).agg(
        F.count("*").alias("rows"), F.min(AXIS).alias("first"), F.max(AXIS).alias("last")
    )


def materialized_slices(spark, sf_dir):
    """The result of a window function stored once, then read as time slices."""
    sql = "SELECT `$timestamp`, user_id, event_id, before FROM {lagged}"
    read = ts.query(
        spark, sql, views={"lagged": window_lag(spark, sf_dir)}, npartitions=5, materialize=True
    )
    return read.groupBy(F.spark_partition_id().alias("slice")).agg(
        F.count("*").alias("rows"),
        F.count("before").alias("with_before"),
        F.sum(F.col("before").cast("decimal(18,2)")).cast("double").alias("sum_before"),
    )


def table_slices(spark, sf_dir):
    """A stored table read as slices without a shuffle."""
    name = temp_name(spark, "run")
    ts.write_dataframe(_orders(spark, sf_dir), name, shard_size="30d").compute()
    read = ts.read_slices(spark, table=name, npartitions=8, scans=True)
    return read.groupBy(F.spark_partition_id().alias("slice")).agg(
        F.count("*").alias("rows"), F.min(AXIS).alias("first"), F.max(AXIS).alias("last")
    )


# -- tables ------------------------------------------------------------------------


def _written(spark: SparkSession, *writes: tuple[DataFrame, dict]) -> DataFrame:
    """What a fresh table holds after *writes* (frame and options), one after another."""
    name = temp_name(spark, "run")
    for frame, options in writes:
        ts.write_dataframe(frame, name, **options).compute()
    return ts.read_table(spark, name)


def write_read_roundtrip(spark, sf_dir):
    return _written(spark, (_events(spark, sf_dir), {}))


def write_long_history(spark, sf_dir):
    """Six years in 30-day shards, with types that widen on the way."""
    return _written(spark, (_lineitem(spark, sf_dir), {"shard_size": "30d"}))


def write_without_shuffle(spark, sf_dir):
    return _written(spark, (_events(spark, sf_dir), {"cluster": False}))


def write_named_axis(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return _written(spark, (orders, {"axis": "o_orderdate", "shard_size": "30d"}))


def write_append(spark, sf_dir):
    """Two appends; the second finds the table and widens nothing."""
    events = _events(spark, sf_dir)
    early = _until(events, "2024-01-20")
    late = _from(events, "2024-01-10")
    return _written(spark, (early, {}), (late, {"create": False}))


def write_transactional(spark, sf_dir):
    return _written(spark, (missing_values(spark, sf_dir), {"push_mode": "transactional"}))


def table_copy(spark, sf_dir):
    """A table queried with its source name and written to a second table."""
    source = temp_name(spark, "run")
    ts.write_dataframe(_events(spark, sf_dir), source).compute()
    read = ts.query(spark, f"SELECT * FROM {source}").withColumn("$table", F.lit(source))
    return _written(spark, (read, {}))


def read_ranges(spark, sf_dir):
    name = temp_name(spark, "run")
    ts.write_dataframe(_events(spark, sf_dir), name, shard_size="12h").compute()
    return ts.read_ranges(
        spark,
        table=name,
        ranges=[
            ("2024-01-03", "2024-01-05T06:00:00"),
            ("2024-01-04T18:00:00", "2024-01-06"),
            ("2024-01-20T01:00:00", "2024-01-20T23:00:00"),
        ],
        column_names=["event_id", "value"],
    )


def write_truncate(spark, sf_dir):
    """Clicks of two days, changed, replace everything from the first to the last of them."""
    events = _events(spark, sf_dir)
    batch = ts.time_range(events, "2024-01-10T06:00:00", "2024-01-12").where(
        "event_type = 'click'"
    )
    changed = batch.withColumn("value", F.col("value") + 1000)
    return _written(spark, (events, {}), (changed, {"push_mode": "truncate"}))


def write_truncate_gap(spark, sf_dir):
    """A batch with rows in its first and last shard only empties the shards between."""
    events = _events(spark, sf_dir)
    first = ts.time_range(events, "2024-01-05T08:00:00", "2024-01-06")
    last = ts.time_range(events, "2024-01-20", "2024-01-20T12:00:00")
    batch = first.unionByName(last)
    return _written(spark, (events, {}), (batch, {"push_mode": "truncate"}))


def _written_to_path(spark: SparkSession, *writes: tuple[DataFrame, dict]) -> DataFrame:
    """The same for a table with a folder of its own below the shared folder."""
    path = f"{shared_folder(spark)}/tickshard_paths/{uuid.uuid4().hex}"
    first, options = writes[0]
    return _written(spark, (first, {**options, "path": path}), *writes[1:])


def write_truncate_gap_path(spark, sf_dir):
    """Shards emptied in a table with a folder of its own; then rows come to one of them."""
    events = _events(spark, sf_dir)
    first = ts.time_range(events, "2024-01-05T08:00:00", "2024-01-06")
    last = ts.time_range(events, "2024-01-20", "2024-01-20T12:00:00")
    again = ts.time_range(events, "2024-01-12", "2024-01-12T01:00:00")
    batch = first.unionByName(last)
    return _written_to_path(spark, (events, {}), (batch, {"push_mode": "truncate"}), (again, {}))


def write_upsert_moves_path(spark, sf_dir):
    """Rows move to other shards of such a table; then rows come to an emptied shard."""
    orders = _orders(spark, sf_dir)
    urgent = orders.where("o_orderpriority = '1-URGENT' OR `$timestamp` < '1995-02-01'")
    later = urgent.withColumn(AXIS, F.col(AXIS) + F.expr("INTERVAL 400 DAYS"))
    again = orders.where("`$timestamp` < '1995-01-08'")
    options = {"deduplicate": ["o_orderkey"], "deduplication_mode": "upsert"}
    return _written_to_path(
        spark, (orders, {"shard_size": "30d"}), (later, options), (again, {})
    )


def read_ranges_many(spark, sf_dir):
    """Half an hour of every hour in which an event falls."""
    events = _events(spark, sf_dir)
    name = temp_name(spark, "run")
    ts.write_dataframe(events, name, shard_size="12h").compute()
    hours = events.select(F.date_trunc("hour", AXIS).cast("timestamp_ntz")).distinct().collect()
    minutes = lambda n: dt.timedelta(minutes=n)
    ranges = [(hour + minutes(10), hour + minutes(40)) for (hour,) in hours]
    return ts.read_ranges(spark, table=name, ranges=ranges, column_names=["event_id"])


def write_dedup_drop(spark, sf_dir):
    """Whole-row repeats of stored rows, and inside the batch, are left out."""
    events = missing_values(spark, sf_dir)
    stored = _until(events, "2024-01-20")
    batch = _from(events, "2024-01-10")
    changed = batch.where("event_type = 'view'").withColumn("user_id", F.col("user_id") + 1)
    again = batch.unionByName(changed).unionByName(batch)
    return _written(spark, (stored, {}), (again, {"deduplicate": True}))


def write_dedup_drop_keys(spark, sf_dir):
    """One row per new key: the last by time."""
    events = _events(spark, sf_dir)
    stored = _until(events, "2024-01-02")
    return _written(spark, (stored, {}), (events, {"deduplicate": ["user_id", "event_type"]}))


def write_dedup_upsert(spark, sf_dir):
    events = _events(spark, sf_dir)
    stored = _until(events, "2024-01-20")
    batch = _from(events, "2024-01-15")
    changed = batch.withColumn("value", F.col("value") + 1)
    options = {"deduplicate": [AXIS, "event_id"], "deduplication_mode": "upsert"}
    return _written(spark, (stored, {}), (changed, options))


def write_upsert_moves(spark, sf_dir):
    """The key is not the time: replaced rows move to other shards, old shards may empty."""
    orders = _orders(spark, sf_dir)
    urgent = orders.where("o_orderpriority = '1-URGENT' OR `$timestamp` < '1995-02-01'")
    later = urgent.withColumn(AXIS, F.col(AXIS) + F.expr("INTERVAL 400 DAYS"))
    options = {"deduplicate": ["o_orderkey"], "deduplication_mode": "upsert"}
    return _written(spark, (orders, {"shard_size": "30d"}), (later, options))


def write_upsert_indexed(spark, sf_dir):
    """The same with an index of the keys: only shards that can hold one are searched."""
    orders = _orders(spark, sf_dir)
    urgent = orders.where("o_orderpriority = '1-URGENT' OR `$timestamp` < '1995-02-01'")
    later = urgent.withColumn(AXIS, F.col(AXIS) + F.expr("INTERVAL 400 DAYS"))
    name = temp_name(spark, "run")
    ts.write_dataframe(orders, name, shard_size="30d").compute()
    ts.index_keys(spark, name, ["o_orderkey"])
    options = {"deduplicate": ["o_orderkey"], "deduplication_mode": "upsert"}
    ts.write_dataframe(later, name, **options).compute()
    return ts.read_table(spark, name)


def _measured_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders, measured from the start, after an append, a truncation and an upsert that
    moves rows to other shards."""
    orders = _orders(spark, sf_dir)
    urgent = orders.where("o_orderpriority = '1-URGENT' OR `$timestamp` < '1995-02-01'")
    later = urgent.withColumn(AXIS, F.col(AXIS) + F.expr("INTERVAL 400 DAYS"))
    doubled = ts.time_range(orders, "1996-01-01", "1996-06-15")
    name = temp_name(spark, "run")
    ts.write_dataframe(_until(orders, "1995-06-10"), name, shard_size="30d").compute()
    ts.measure_columns(spark, name, ["o_totalprice", "o_custkey"])
    ts.write_dataframe(_from(orders, "1995-06-10"), name).compute()
    ts.write_dataframe(doubled, name, push_mode="truncate").compute()
    options = {"deduplicate": ["o_orderkey"], "deduplication_mode": "upsert"}
    ts.write_dataframe(later, name, **options).compute()
    return name


def global_stats_stored(spark, sf_dir):
    """Statistics of a table that was written in four ways, from its stored moments."""
    name = _measured_orders(spark, sf_dir)
    stats = ts.stored_stats(spark, name, "o_totalprice", "o_custkey")
    exact = stats.withColumn("sum_o_custkey", F.col("sum_o_custkey").cast("bigint"))
    return _rounded(exact, *[c for c in stats.columns if c != "sum_o_custkey"])


def range_stats_stored(spark, sf_dir):
    """The same within ranges of time that cover some shards in part."""
    name = _measured_orders(spark, sf_dir)
    ranges = [("1993-03-07", "1995-11-02"), ("1997-01-01", "1997-01-05")]
    stats = ts.stored_stats(spark, name, "o_totalprice", ranges=ranges)
    return _rounded(stats, *stats.columns)


# -- as-of joins and windows ---------------------------------------------------------


def _asof_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Purchases, each to find the last click before it."""
    events = _events(spark, sf_dir)
    left = events.where("event_type = 'purchase'").select(AXIS, "event_id", "user_id")
    right = events.where("event_type = 'click'").select(AXIS, "user_id", "value")
    return left, right


def asof_backward(spark, sf_dir):
    left, right = _asof_sides(spark, sf_dir)
    return ts.asof_join(left, right, on=["user_id"])


def asof_hot_keys(spark, sf_dir):
    """The same join with every key cut into time segments."""
    left, right = _asof_sides(spark, sf_dir)
    return ts.asof_join(left, right, on=["user_id"], hot_rows=10, splits=2000)


def asof_no_key(spark, sf_dir):
    left, right = _asof_sides(spark, sf_dir)
    return ts.asof_join(left, right.drop("user_id"), hot_rows=50)


def asof_ties(spark, sf_dir):
    """Many rows at one instant on both sides; the dearest order of the day wins."""
    left = _lineitem(spark, sf_dir).select(AXIS, "l_orderkey", "l_linenumber")
    right = _orders(spark, sf_dir).select(AXIS, "o_totalprice")
    return ts.asof_join(left, right, tie=["o_totalprice"], hot_rows=500)


def window_lag(spark, sf_dir):
    """The value of a user's row before, with the rows of busy users cut into segments."""
    events = _events(spark, sf_dir).select(AXIS, "event_id", "user_id", "value")
    return ts.lagged(events, {"before": "value"}, on=["user_id"], order=["event_id"])


def window_lag_hot_keys(spark, sf_dir):
    """The same with every user cut into segments."""
    events = _events(spark, sf_dir).select(AXIS, "event_id", "user_id", "value")
    return ts.lagged(
        events, {"before": "value"}, on=["user_id"], order=["event_id"], hot_rows=20, splits=2000
    )


def window_lag_text_order(spark, sf_dir):
    """A text decides between rows of one day, with every status cut into segments."""
    orders = _orders(spark, sf_dir)
    orders = orders.select(
        AXIS, "o_orderstatus", F.md5(F.col("o_orderkey").cast("string")).alias("tag")
    )
    return ts.lagged(orders, {"before": "tag"}, on=["o_orderstatus"], order=["tag"], hot_rows=20)


def window_lag_sql(spark, sf_dir):
    """The plain window in SQL, where no key can be big: the lines of one order."""
    sql = """SELECT `$timestamp`, l_orderkey, l_linenumber, lag(l_quantity) OVER
                    (PARTITION BY l_orderkey ORDER BY `$timestamp`, l_linenumber, l_partkey,
                                  l_suppkey, l_quantity) AS before
             FROM {lineitem}"""
    return ts.query(spark, sql, views={"lineitem": _lineitem(spark, sf_dir)})


def window_rolling(spark, sf_dir):
    events = _events(spark, sf_dir).select(AXIS, "event_id", "user_id")
    placed = ts.numbered(events, "nth", on=["user_id"], order=["event_id"])
    return ts.counted_within(placed, "last_day", "1d", on=["user_id"])


def window_number_hot_keys(spark, sf_dir):
    """Places in a long history per status, with every status cut into segments."""
    orders = _orders(spark, sf_dir).select(AXIS, "o_orderkey", "o_orderstatus")
    return ts.numbered(
        orders, "nth", on=["o_orderstatus"], order=["o_orderkey"], hot_rows=100
    )


def window_rolling_hot_keys(spark, sf_dir):
    """Rolling counts with every key cut into segments; dates have many ties."""
    orders = _orders(spark, sf_dir).select(AXIS, "o_orderkey", "o_orderstatus")
    return ts.counted_within(
        orders, "last_month", "30d", on=["o_orderstatus"], hot_rows=100
    )


def _busy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(AXIS, "o_orderkey", "o_orderstatus", "o_custkey")


def bucket_count_filled(spark, sf_dir):
    """Every hour of six years for each status, with the last customer up to it."""
    orders = _busy_orders(spark, sf_dir).where("o_custkey % 3 > 0 OR o_orderstatus = 'P'")
    return ts.bucket_filled(
        orders, "1h", "o_orderkey", on=["o_orderstatus"], carry={"customer": "o_custkey"}
    )


def bucket_minutes_filled(spark, sf_dir):
    """Every minute of the events, added up by day."""
    filled = ts.bucket_filled(_events(spark, sf_dir), "1min", "event_id")
    return filled.groupBy(F.date_trunc("day", AXIS).cast("timestamp_ntz").alias("day")).agg(
        F.count("*").alias("minutes"),
        F.sum("count(event_id)").alias("events"),
        F.count_if(F.col("count(event_id)") == 0).alias("empty"),
    )


_EVERY_STATUS = {"on": ["o_orderstatus"], "hot_rows": 100}


def window_sum_hot_keys(spark, sf_dir):
    """Rolling sum, count and mean with every key cut into segments; dates have many ties."""
    columns = {"total": ("sum", "o_custkey"), "n": ("count", "o_custkey"), "mean": ("mean", "o_custkey")}
    return ts.rolled_within(_busy_orders(spark, sf_dir), columns, "30d", **_EVERY_STATUS)


def window_max_hot_keys(spark, sf_dir):
    """Rolling least and greatest over a range that spans many segments."""
    columns = {"least": ("min", "o_custkey"), "greatest": ("max", "o_custkey")}
    return ts.rolled_within(_busy_orders(spark, sf_dir), columns, "200d", **_EVERY_STATUS)


def window_rank_hot_keys(spark, sf_dir):
    """Ranks by the day alone, so that ties lie on cut points."""
    return ts.ranked(_busy_orders(spark, sf_dir), "place", **_EVERY_STATUS)


def window_dense_rank_hot_keys(spark, sf_dir):
    return ts.ranked(
        _busy_orders(spark, sf_dir), "place", order=["o_custkey"], dense=True, **_EVERY_STATUS
    )


def window_ntile_hot_keys(spark, sf_dir):
    return ts.tiled(_busy_orders(spark, sf_dir), "part", 13, order=["o_orderkey"], **_EVERY_STATUS)


def window_lead_hot_keys(spark, sf_dir):
    columns = {"following": "o_custkey", "at": AXIS}
    return ts.led(_busy_orders(spark, sf_dir), columns, order=["o_orderkey"], **_EVERY_STATUS)


# -- streams -----------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """What a table holds after a stream over the events files has caught up."""
    schema = _table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    name = temp_name(spark, "run")
    checkpoint = f"{shared_folder(spark)}/tickshard_streams/{name}"
    ts.write_stream(
        stream, name, checkpoint=checkpoint, axis="ts", available_now=True, **options
    ).awaitTermination()
    return ts.read_table(spark, name)


def stream_append(spark, sf_dir):
    return _streamed(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Events of a time range, counted per hour."""
    events = _events(spark, "/root/testdata/sf0.001")
    return ts.bucket_count(ts.time_range(events, "2024-01-08", "2024-01-16"), "1h", "value")


def queries() -> dict[str, Query]:
    return {
        "select_star": select_star,
        "select_star_range": select_star_range,
        "select_alias": select_alias,
        "select_alias_range": select_alias_range,
        "select_hides_internal": select_hides_internal,
        "declared_schema": declared_schema,
        "axis_from_text": axis_from_text,
        "axis_from_zoned": axis_from_zoned,
        "coerced_types": coerced_types,
        "missing_values": missing_values,
        "bucket_count_1h": _bucket_counts("events", "ts", "1h", "value", "props"),
        "bucket_count_1d": _bucket_counts("events", "ts", "1d", "value", "props"),
        "bucket_count_7h": _bucket_counts("events", "ts", "7h", "value"),
        "bucket_count_lineitem": _bucket_counts("lineitem", "l_shipdate", "1w", "l_quantity"),
        "bucket_count_missing": bucket_count_missing,
        "bucket_count_sql": bucket_count_sql,
        "global_stats": global_stats,
        "global_stats_broadcast": global_stats_broadcast,
        "global_stats_broadcast_integers": global_stats_broadcast_integers,
        "slice_bounds": slice_bounds,
        "slice_counts": _slice_counts("events", "ts", 7),
        "slice_counts_orders": _slice_counts("orders", "o_orderdate", 8),
        "slice_counts_lineitem": _slice_counts("lineitem", "l_shipdate", 1000),
        "sliced_partitions": sliced_partitions,
        "table_slices": table_slices,
        "materialized_slices": materialized_slices,
        "write_read_roundtrip": write_read_roundtrip,
        "write_long_history": write_long_history,
        "write_without_shuffle": write_without_shuffle,
        "write_named_axis": write_named_axis,
        "write_append": write_append,
        "write_transactional": write_transactional,
        "table_copy": table_copy,
        "read_ranges": read_ranges,
        "write_truncate": write_truncate,
        "write_truncate_gap": write_truncate_gap,
        "write_truncate_gap_path": write_truncate_gap_path,
        "write_upsert_moves_path": write_upsert_moves_path,
        "read_ranges_many": read_ranges_many,
        "global_stats_large": global_stats_large,
        "write_dedup_drop": write_dedup_drop,
        "write_dedup_drop_keys": write_dedup_drop_keys,
        "write_dedup_upsert": write_dedup_upsert,
        "write_upsert_moves": write_upsert_moves,
        "write_upsert_indexed": write_upsert_indexed,
        "global_stats_stored": global_stats_stored,
        "range_stats_stored": range_stats_stored,
        "asof_backward": asof_backward,
        "asof_hot_keys": asof_hot_keys,
        "asof_no_key": asof_no_key,
        "asof_ties": asof_ties,
        "window_lag": window_lag,
        "window_lag_hot_keys": window_lag_hot_keys,
        "window_lag_text_order": window_lag_text_order,
        "window_lag_sql": window_lag_sql,
        "window_rolling": window_rolling,
        "window_number_hot_keys": window_number_hot_keys,
        "window_rolling_hot_keys": window_rolling_hot_keys,
        "bucket_count_filled": bucket_count_filled,
        "bucket_minutes_filled": bucket_minutes_filled,
        "window_sum_hot_keys": window_sum_hot_keys,
        "window_max_hot_keys": window_max_hot_keys,
        "window_rank_hot_keys": window_rank_hot_keys,
        "window_dense_rank_hot_keys": window_dense_rank_hot_keys,
        "window_ntile_hot_keys": window_ntile_hot_keys,
        "window_lead_hot_keys": window_lead_hot_keys,
        "stream_append": stream_append,
        **_corpus(),
    }


def _stats_sql(column: str, rounded_sum: bool) -> str:
    total = f"coalesce(sum({column}), 0)"
    total = f"round({total}, 4)" if rounded_sum else f"CAST({total} AS BIGINT)"
    return (
        f"{total} AS sum_{column}, round(avg({column}), 4) AS mean_{column}, "
        f"round(stddev_samp({column}), 4) AS std_{column}"
    )


_ALL_EVENTS = f"SELECT {_EVENT_COLUMNS} FROM events"

_BUSY = 'SELECT o_orderdate AS "$timestamp", o_orderkey, o_orderstatus, o_custkey'
_LAG = """
    SELECT ts AS "$timestamp", event_id, user_id, value,
           lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
    FROM events"""

_ASOF = """
    SELECT l.ts AS "$timestamp", l.event_id, l.user_id, r.ts AS matched_at, r.value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') l
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r
    ON {keys} l.ts >= r.ts"""


def oracle_sql() -> dict[str, str]:
    return {
        "select_star": _ALL_EVENTS,
        "select_star_range": f"""{_ALL_EVENTS}
            WHERE ts >= '2024-01-08' AND ts < '2024-01-15 12:30:00.000001'""",
        "select_alias": """
            SELECT ts AS "$timestamp", value AS value_alias, props AS props_alias FROM events""",
        "select_alias_range": """
            SELECT ts AS "$timestamp", value AS value_alias FROM events
            WHERE ts >= '2024-01-01' AND ts < '2024-01-08'""",
        "select_hides_internal": _ALL_EVENTS,
        "declared_schema": """
            SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate AS "$timestamp",
                   l_orderkey, CAST(NULL AS VARCHAR) AS comment, CAST(NULL AS VARCHAR) AS flag
            FROM lineitem""",
        "axis_from_text": 'SELECT ts AS "$timestamp", event_id FROM events',
        "axis_from_zoned": 'SELECT ts AS "$timestamp", event_id FROM events',
        "coerced_types": """
            SELECT l_shipdate AS "$timestamp", l_orderkey, CAST(l_linenumber AS BIGINT) AS line,
                   l_quantity AS quantity, l_suppkey AS supplier, l_shipdate AS shipped,
                   l_partkey AS part
            FROM lineitem""",
        "missing_values": f"SELECT {_EVENT_COLUMNS} FROM ({_GAPPY})",
        "bucket_count_1h": _bucket_counts_sql("events", "ts", "1 hour", "value", "props"),
        "bucket_count_1d": _bucket_counts_sql("events", "ts", "1 day", "value", "props"),
        "bucket_count_7h": _bucket_counts_sql("events", "ts", "7 hours", "value"),
        "bucket_count_lineitem": _bucket_counts_sql(
            "lineitem", "l_shipdate", "7 days", "l_quantity"
        ),
        "bucket_count_missing": _bucket_counts_sql(
            f"({_GAPPY})", "ts", "1 hour", "value", "props", "event_id"
        ),
        "bucket_count_sql": _bucket_counts_sql(f"({_GAPPY})", "ts", "1 hour", "value"),
        "global_stats": f"""
            SELECT {_stats_sql("l_extendedprice", True)}, {_stats_sql("l_quantity", True)}
            FROM lineitem""",
        "global_stats_broadcast": f"""
            SELECT ts AS "$timestamp", event_id, s.*
            FROM events, (SELECT {_stats_sql("value", True)} FROM ({_GAPPY})) s""",
        "global_stats_broadcast_integers": f"""
            SELECT l_orderkey, l_linenumber, s.*
            FROM lineitem, (SELECT {_stats_sql("l_partkey", False)} FROM lineitem) s""",
        "slice_bounds": """
            SELECT CAST(i AS INTEGER) AS slice,
                   make_timestamp(CAST(lo + i * span // 7 AS BIGINT)) AS lo,
                   make_timestamp(CAST(lo + (i + 1) * span // 7 AS BIGINT)) AS hi
            FROM range(7) t(i),
                 (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) - min(epoch_us(ts)) + 1 AS span
                  FROM events)""",
        "slice_counts": _slice_counts_sql("events", "ts", 7),
        "slice_counts_orders": _slice_counts_sql("orders", "o_orderdate", 8),
        "slice_counts_lineitem": _slice_counts_sql("lineitem", "l_shipdate", 1000),
        "sliced_partitions": f"""
            SELECT slice, count(*) AS rows, min(o_orderdate) AS first, max(o_orderdate) AS last
            FROM ({_slice_sql("o_orderdate", 8, "SELECT o_orderdate FROM orders")})
            GROUP BY slice""",
        "table_slices": f"""
            SELECT slice, count(*) AS rows, min(o_orderdate) AS first, max(o_orderdate) AS last
            FROM ({_slice_sql("o_orderdate", 8, "SELECT o_orderdate FROM orders")})
            GROUP BY slice""",
        "materialized_slices": f"""
            SELECT slice, count(*) AS rows, count(before) AS with_before,
                   CAST(sum(CAST(before AS DECIMAL(18, 2))) AS DOUBLE) AS sum_before
            FROM ({_slice_sql('"$timestamp"', 5, _LAG)}) GROUP BY slice""",
        "write_read_roundtrip": _ALL_EVENTS,
        "write_long_history": """
            SELECT l_shipdate AS "$timestamp",
                   * EXCLUDE (l_shipdate) REPLACE (CAST(l_linenumber AS BIGINT) AS l_linenumber)
            FROM lineitem""",
        "write_without_shuffle": _ALL_EVENTS,
        "write_named_axis": """
            SELECT o_orderdate AS "$timestamp", * EXCLUDE (o_orderdate) FROM orders""",
        "write_append": f"""
            {_ALL_EVENTS} WHERE ts < '2024-01-20'
            UNION ALL {_ALL_EVENTS} WHERE ts >= '2024-01-10'""",
        "write_transactional": f"SELECT {_EVENT_COLUMNS} FROM ({_GAPPY})",
        "table_copy": _ALL_EVENTS,
        "read_ranges": """
            SELECT ts AS "$timestamp", event_id, value FROM events
            WHERE (ts >= '2024-01-03' AND ts < '2024-01-06')
               OR (ts >= '2024-01-20 01:00:00' AND ts < '2024-01-20 23:00:00')""",
        "write_truncate": """
            WITH batch AS (
                SELECT * REPLACE (value + 1000 AS value) FROM events
                WHERE ts >= '2024-01-10 06:00:00' AND ts < '2024-01-12'
                  AND event_type = 'click'),
            ends AS (SELECT min(ts) AS lo, max(ts) AS hi FROM batch)
            SELECT ts AS "$timestamp", * EXCLUDE (ts) FROM (
                SELECT e.* FROM events e, ends WHERE e.ts < lo OR e.ts > hi
                UNION ALL SELECT * FROM batch)""",
        "write_truncate_gap": """
            WITH batch AS (
                SELECT * FROM events
                WHERE (ts >= '2024-01-05 08:00:00' AND ts < '2024-01-06')
                   OR (ts >= '2024-01-20' AND ts < '2024-01-20 12:00:00')),
            ends AS (SELECT min(ts) AS lo, max(ts) AS hi FROM batch)
            SELECT ts AS "$timestamp", * EXCLUDE (ts) FROM (
                SELECT e.* FROM events e, ends WHERE e.ts < lo OR e.ts > hi
                UNION ALL SELECT * FROM batch)""",
        "write_truncate_gap_path": """
            WITH batch AS (
                SELECT * FROM events
                WHERE (ts >= '2024-01-05 08:00:00' AND ts < '2024-01-06')
                   OR (ts >= '2024-01-20' AND ts < '2024-01-20 12:00:00')),
            ends AS (SELECT min(ts) AS lo, max(ts) AS hi FROM batch)
            SELECT ts AS "$timestamp", * EXCLUDE (ts) FROM (
                SELECT e.* FROM events e, ends WHERE e.ts < lo OR e.ts > hi
                UNION ALL SELECT * FROM batch
                UNION ALL SELECT * FROM events
                WHERE ts >= '2024-01-12' AND ts < '2024-01-12 01:00:00')""",
        "write_upsert_moves_path": """
            SELECT CASE WHEN o_orderpriority = '1-URGENT' OR o_orderdate < '1995-02-01'
                        THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS "$timestamp",
                   * EXCLUDE (o_orderdate)
            FROM orders
            UNION ALL SELECT o_orderdate, * EXCLUDE (o_orderdate) FROM orders
            WHERE o_orderdate < '1995-01-08'""",
        "read_ranges_many": """
            SELECT ts AS "$timestamp", event_id FROM events
            WHERE minute(ts) >= 10 AND minute(ts) < 40""",
        "global_stats_large": """
            SELECT CAST(sum(CAST(l_partkey AS HUGEINT) * 1000000000000
                            + CAST(l_orderkey AS HUGEINT) * 100000000000) AS VARCHAR) AS sum_large
            FROM lineitem""",
        "write_dedup_drop": f"""
            WITH gappy AS ({_GAPPY}),
            stored AS (SELECT * FROM gappy WHERE ts < '2024-01-20'),
            late AS (SELECT * FROM gappy WHERE ts >= '2024-01-10'),
            batch AS (
                SELECT * FROM late UNION
                SELECT * REPLACE (user_id + 1 AS user_id) FROM late WHERE event_type = 'view')
            SELECT {_EVENT_COLUMNS} FROM (
                SELECT * FROM stored UNION ALL
                SELECT * FROM (SELECT * FROM batch EXCEPT SELECT * FROM stored))""",
        "write_dedup_drop_keys": f"""
            WITH stored AS (SELECT * FROM events WHERE ts < '2024-01-02'),
            fresh AS (
                SELECT e.* FROM events e WHERE NOT EXISTS (
                    SELECT 1 FROM stored s
                    WHERE s.user_id = e.user_id AND s.event_type = e.event_type)
                QUALIFY row_number() OVER (
                    PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
            SELECT {_EVENT_COLUMNS} FROM (SELECT * FROM stored UNION ALL SELECT * FROM fresh)""",
        "write_dedup_upsert": f"""
            WITH stored AS (SELECT * FROM events WHERE ts < '2024-01-20'),
            batch AS (SELECT * REPLACE (value + 1 AS value) FROM events WHERE ts >= '2024-01-15')
            SELECT {_EVENT_COLUMNS} FROM (
                SELECT s.* FROM stored s WHERE NOT EXISTS (
                    SELECT 1 FROM batch b WHERE b.ts = s.ts AND b.event_id = s.event_id)
                UNION ALL SELECT * FROM batch)""",
        "write_upsert_moves": """
            SELECT CASE WHEN o_orderpriority = '1-URGENT' OR o_orderdate < '1995-02-01'
                        THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS "$timestamp",
                   * EXCLUDE (o_orderdate)
            FROM orders""",
        "write_upsert_indexed": """
            SELECT CASE WHEN o_orderpriority = '1-URGENT' OR o_orderdate < '1995-02-01'
                        THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS "$timestamp",
                   * EXCLUDE (o_orderdate)
            FROM orders""",
        "global_stats_stored": f"""
            SELECT {_stats_sql("o_totalprice", True)}, {_stats_sql("o_custkey", False)}
            FROM orders""",
        "range_stats_stored": f"""
            SELECT {_stats_sql("o_totalprice", True)}
            FROM (SELECT o_totalprice,
                         CASE WHEN o_orderpriority = '1-URGENT' OR o_orderdate < '1995-02-01'
                              THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS t
                  FROM orders)
            WHERE t >= '1993-03-07' AND t < '1995-11-02' OR t >= '1997-01-01' AND t < '1997-01-05'""",
        "asof_backward": _ASOF.format(keys="l.user_id = r.user_id AND"),
        "asof_hot_keys": _ASOF.format(keys="l.user_id = r.user_id AND"),
        "asof_no_key": _ASOF.format(keys=""),
        "asof_ties": """
            SELECT l.l_shipdate AS "$timestamp", l.l_orderkey, l.l_linenumber,
                   r.o_orderdate AS matched_at, r.o_totalprice
            FROM lineitem l ASOF LEFT JOIN (
                SELECT o_orderdate, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1) r
            ON l.l_shipdate >= r.o_orderdate""",
        "window_lag": _LAG,
        "window_lag_hot_keys": _LAG,
        "window_lag_text_order": """
            SELECT "$timestamp", o_orderstatus, tag, lag(tag) OVER
                   (PARTITION BY o_orderstatus ORDER BY "$timestamp", tag) AS before
            FROM (SELECT o_orderdate AS "$timestamp", o_orderstatus,
                         md5(CAST(o_orderkey AS VARCHAR)) AS tag FROM orders)""",
        "window_lag_sql": """
            SELECT l_shipdate AS "$timestamp", l_orderkey, l_linenumber, lag(l_quantity) OVER
                   (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey,
                                 l_suppkey, l_quantity) AS before
            FROM lineitem""",
        "window_rolling": """
            SELECT ts AS "$timestamp", event_id, user_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth,
                   count(*) OVER (PARTITION BY user_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS last_day
            FROM events""",
        "window_number_hot_keys": """
            SELECT o_orderdate AS "$timestamp", o_orderkey, o_orderstatus,
                   row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey)
                       AS nth
            FROM orders""",
        "window_rolling_hot_keys": """
            SELECT o_orderdate AS "$timestamp", o_orderkey, o_orderstatus,
                   count(*) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate
                       RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS last_month
            FROM orders""",
        "bucket_count_filled": """
            WITH held AS (
                SELECT o_orderstatus, date_trunc('hour', o_orderdate) AS b, count(o_orderkey) AS n,
                       arg_max(o_custkey, (o_orderdate, o_custkey)) AS c
                FROM orders WHERE o_custkey % 3 > 0 OR o_orderstatus = 'P' GROUP BY ALL),
            spans AS (
                SELECT o_orderstatus,
                       unnest(generate_series(min(b), max(b), INTERVAL 1 HOUR)) AS b
                FROM held GROUP BY o_orderstatus)
            SELECT o_orderstatus, CAST(b AS TIMESTAMP) AS "$timestamp",
                   coalesce(n, 0) AS "count(o_orderkey)",
                   last_value(c IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY b
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS customer
            FROM spans LEFT JOIN held USING (o_orderstatus, b)""",
        "bucket_minutes_filled": """
            WITH held AS (
                SELECT date_trunc('minute', ts) AS b, count(event_id) AS n FROM events GROUP BY 1),
            spans AS (
                SELECT unnest(generate_series(min(b), max(b), INTERVAL 1 MINUTE)) AS b FROM held)
            SELECT CAST(date_trunc('day', b) AS TIMESTAMP) AS day, count(*) AS minutes,
                   CAST(sum(coalesce(n, 0)) AS BIGINT) AS events, CAST(count_if(n IS NULL) AS BIGINT) AS empty
            FROM spans LEFT JOIN held USING (b) GROUP BY 1""",
        "window_sum_hot_keys": f"""
            {_BUSY}, CAST(sum(o_custkey) OVER rolling AS BIGINT) AS total,
                   count(o_custkey) OVER rolling AS n, avg(o_custkey) OVER rolling AS mean
            FROM orders WINDOW rolling AS (PARTITION BY o_orderstatus ORDER BY o_orderdate
                RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
        "window_max_hot_keys": f"""
            {_BUSY}, min(o_custkey) OVER rolling AS least, max(o_custkey) OVER rolling AS greatest
            FROM orders WINDOW rolling AS (PARTITION BY o_orderstatus ORDER BY o_orderdate
                RANGE BETWEEN INTERVAL 200 DAY PRECEDING AND CURRENT ROW)""",
        "window_rank_hot_keys": f"""
            {_BUSY}, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) AS place
            FROM orders""",
        "window_dense_rank_hot_keys": f"""
            {_BUSY}, dense_rank() OVER (PARTITION BY o_orderstatus
                ORDER BY o_orderdate, o_custkey) AS place FROM orders""",
        "window_ntile_hot_keys": f"""
            {_BUSY}, ntile(13) OVER (PARTITION BY o_orderstatus
                ORDER BY o_orderdate, o_orderkey) AS part FROM orders""",
        "window_lead_hot_keys": f"""
            {_BUSY}, lead(o_custkey) OVER following AS following, lead(o_orderdate) OVER following AS at
            FROM orders WINDOW following AS (PARTITION BY o_orderstatus
                ORDER BY o_orderdate, o_orderkey)""",
        "stream_append": _ALL_EVENTS,
        **({} if corpus_queries is None else corpus_queries.ORACLE_SQL),
    }
