"""Window functions against brute force, with and without segments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.functions import micros
from tickshard.operators.running import _segmented
from tickshard.operators.segments import crowded_cuts, find_hot_keys, with_hot_number, with_segment

START = dt.datetime(2024, 1, 1)
OPTIONS = [{}, {"hot_rows": 3, "splits": 2}, {"hot_rows": 1, "splits": 60}]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    keys = ["a"] * 5 + ["b", "c", None]
    times = [rng.randrange(50) for _ in range(15)] + [7] * 10
    return [(rng.choice(times), rng.choice(keys), i, rng.choice([None, 1, 2])) for i in range(150)]


def frame(spark, rows):
    data = [(START + dt.timedelta(hours=t), k, i, v) for t, k, i, v in rows]
    ddl = "`$timestamp` timestamp_ntz, k string, id bigint, v bigint"
    return spark.createDataFrame(data, ddl).repartition(4)


@pytest.mark.parametrize("options", OPTIONS)
def test_lag_and_place(spark, rows, options):
    df = frame(spark, rows)
    lag = {r.id: (r.p, r.pid) for r in
           ts.lagged(df, {"p": "v", "pid": "id"}, on=["k"], order=["id"], **options).collect()}
    place = {r.id: r.n for r in ts.numbered(df, "n", on=["k"], order=["id"], **options).collect()}
    for key in {k for _, k, _, _ in rows}:
        mine = sorted((t, i, v) for t, k, i, v in rows if k == key)
        for n, (t, i, v) in enumerate(mine):
            assert place[i] == n + 1
            assert lag[i] == ((mine[n - 1][2], mine[n - 1][1]) if n else (None, None))
    assert len(lag) == len(place) == len(rows)


@pytest.mark.parametrize("options", OPTIONS)
def test_count_within(spark, rows, options):
    got = {r.id: r.n for r in ts.counted_within(frame(spark, rows), "n", "5h", on=["k"], **options).collect()}
    assert got == {
        i: sum(k2 == k and t - 5 <= t2 <= t for t2, k2, _, _ in rows) for t, k, i, _ in rows
    }


def test_columns_are_kept(spark, rows):
    df = frame(spark, rows).withColumnRenamed("v", "a b")
    assert ts.lagged(df, {"x": "a b"}, on=["k"]).columns == [*df.columns, "x"]
    assert ts.numbered(df, "n", on=["k"]).columns == [*df.columns, "n"]
    with pytest.raises(ValueError):
        ts.numbered(df, "n", on=[])


def crowd(spark, copies, others):
    """A key with most of its rows at one instant: copies of one row, and other rows."""
    at = F.lit(START + dt.timedelta(hours=9)).cast("timestamp_ntz")
    same = spark.range(0, copies, 1, 6).select(at.alias("$timestamp"), F.lit("a").alias("k"),
                                                F.lit(7).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("v"))
    rows = [(t, "a", i, i) for i, t in enumerate([1, 2, 9, 9, 9, 12, 13] * others)]
    return same.unionByName(frame(spark, rows))


@pytest.mark.parametrize("order", [(), ("id",), ("v", "id")])
def test_crowded_instant_is_split(spark, order):
    df = crowd(spark, 600, 30)
    hot = {"on": ["k"], "hot_rows": 5, "splits": 8}
    places = ts.numbered(df, "n", order=order, **hot).orderBy("n").collect()
    assert [r.n for r in places] == list(range(1, 811))
    keys = [(r["$timestamp"], *(r[c] for c in order)) for r in places]
    assert keys == sorted(keys)
    lag = ts.lagged(df, {"t": "$timestamp", "x": "id", "y": "v"}, order=order, **hot)
    pairs = {(r["$timestamp"], *(r[c] for c in order)): set() for r in places}
    before = [None, *[(r["$timestamp"], *(r[c] for c in order)) for r in places]]
    for b, r in zip(before, places):
        pairs[(r["$timestamp"], *(r[c] for c in order))].add(b)
    for r in lag.collect():
        values = {"$timestamp": r.t, "id": r.x, "v": r.y}
        b = None if r.t is None else (r.t, *(values[c] for c in order))
        assert b in pairs[(r["$timestamp"], *(r[c] for c in order))]
    assert lag.where("t IS NULL").count() == 1
    counts = ts.counted_within(df, "n", "3h", **hot)
    got = {(r["$timestamp"].hour, r.n) for r in counts.collect()}
    assert got == {(1, 30), (2, 60), (9, 690), (12, 720), (13, 60)} and counts.count() == 810


# Each text makes an order column from a number i below 3,000 whose order is that of i.
ORDERS = {
    "text": "format_string('%05d', i)",
    "long text": "concat('same beginning ', format_string('%05d', i))",
    "other letters": "concat(chr(cast(945 + i div 150 as bigint)), format_string('%05d', i))",
    "bytes": "cast(format_string('%05d', i) as binary)",
    "date": "date_add(date'1965-01-01', cast(i as int))",
    "double": "if(i = 2999, double('NaN'), if(i = 2998, double('Infinity'), (i - 1500) / 7e0))",
    "decimal": "cast((i - 1500) / 8 as decimal(12,3))",
    "flag": "i >= 1500",
}


@pytest.mark.parametrize("kind", ORDERS)
def test_crowded_instant_in_any_order(spark, kind):
    at = F.lit(START).cast("timestamp_ntz").alias("$timestamp")
    place = F.expr(ORDERS[kind]).alias("o")
    df = spark.range(0, 3000, 1, 5).select(at, F.lit("a").alias("k"), F.col("id").alias("i"))
    df = df.select("*", place).select("*", F.when(F.col("i") > 9, F.col("o")).alias("x"))
    hot = {"on": ["k"], "order": ["x", "i"], "hot_rows": 100, "splits": 8}
    rows, _, _ = _segmented(df, ["k"], ["x", "i"], 100, 8)
    sizes = [r["count"] for r in rows.groupBy("segment").count().collect()]
    if kind not in ("long text", "flag"):
        assert sum(sizes) == 3000 and max(sizes) <= 2 * 3000 / 7  # seven segments meet here
    got = ts.numbered(df, "n", **hot).collect()
    assert all(r.n == r.i + 1 for r in got) and len(got) == 3000
    lag = ts.lagged(df, {"p": "i"}, **hot).collect()
    assert all(r.p == (r.i - 1 if r.i else None) for r in lag) and len(lag) == 3000
    alone = ts.numbered(df, "n", on=["k"], order=["x"], hot_rows=100, splits=8).collect()
    assert sorted(r.n for r in alone) == list(range(1, 3001))
    if kind != "flag":
        assert all(r.n == r.i + 1 for r in alone if r.i > 9)


def test_crowded_instant_goes_to_several_segments(spark):
    times = crowd(spark, 6000, 10).select(
        F.col("k").alias("k0"), F.col("id").alias("u"), micros().alias("t")
    )
    hot_keys = find_hot_keys(times.select("k0", "t"), ["k0"], 100, 8)
    rows = with_hot_number(times, hot_keys, ["k0"])
    for inner in (None, crowded_cuts(rows, hot_keys, 8)):
        placed = with_segment(rows, hot_keys, spread=True, inner=inner)
        sizes = [r["count"] for r in placed.groupBy("segment").count().collect()]
        assert sum(sizes) == 6070 and max(sizes) < 2000


@pytest.mark.parametrize("options", OPTIONS[:2])
def test_rows_without_a_time_count_for_nothing(spark, options):
    df = frame(spark, [(1, "a", 1, 1), (2, "a", 2, 1)] * 4).unionByName(
        spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS `$timestamp`, 'a' AS k, 9L AS id, 0L AS v")
    )
    got = {(r.id, r.n) for r in ts.counted_within(df, "n", "1h", on=["k"], **options).collect()}
    assert got == {(1, 4), (2, 8), (9, None)}


@pytest.mark.parametrize("options", OPTIONS)
def test_lead_rank_and_tile(spark, rows, options):
    df = frame(spark, rows)
    lead = {r.id: (r.p, r.pid) for r in
            ts.led(df, {"p": "v", "pid": "id"}, on=["k"], order=["id"], **options).collect()}
    get = lambda f, *a, order=(), **k: {
        r.id: r.n for r in f(df, "n", *a, on=["k"], order=order, **k, **options).collect()}
    by_time, by_value = get(ts.ranked), get(ts.ranked, order=["v"])
    dense, tiles = get(ts.ranked, order=["v"], dense=True), get(ts.tiled, 7, order=["id"])
    for key in {k for _, k, _, _ in rows}:
        mine = sorted((t, i, v) for t, k, i, v in rows if k == key)
        places = sorted((t, v is not None, v or 0) for t, _, v in mine)
        size, more = divmod(len(mine), 7)
        for n, (t, i, v) in enumerate(mine):
            assert lead[i] == ((mine[n + 1][2], mine[n + 1][1]) if n + 1 < len(mine) else (None, None))
            assert by_time[i] == 1 + sum(x[0] < t for x in mine)
            own = (t, v is not None, v or 0)
            assert by_value[i] == 1 + places.index(own)
            assert dense[i] == 1 + len({p for p in places if p < own})
            ahead = more * (size + 1)
            assert tiles[i] == 1 + (n // (size + 1) if n < ahead else more + (n - ahead) // size)
    with pytest.raises(ValueError):
        ts.tiled(df, "n", 0, on=["k"])


@pytest.mark.parametrize("order", [(), ("id",), ("v", "id")])
def test_ranks_across_cut_points(spark, order):
    """A key with most rows at one instant, equal and different ones, in eight segments."""
    df = crowd(spark, 600, 30)
    hot = {"on": ["k"], "hot_rows": 5, "splits": 8}
    for dense in (False, True):
        found = ts.ranked(df, "n", order=order, dense=dense, **hot).collect()
        places = sorted(tuple(r[c] for c in ("$timestamp", *order)) for r in found)
        different = sorted(set(places))
        for r in found:
            own = tuple(r[c] for c in ("$timestamp", *order))
            assert r.n == 1 + (different if dense else places).index(own)
    lead = ts.led(df, {"t": "$timestamp"}, order=order, **hot).collect()
    assert sum(r.t is None for r in lead) == 1 and all(r.t is None or r.t >= r["$timestamp"] for r in lead)
    tiles = ts.tiled(df, "n", 4, order=order, **hot).groupBy("n").count().collect()
    assert {r.n: r["count"] for r in tiles} == {1: 203, 2: 203, 3: 202, 4: 202}


ROLLED = {"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "id"), "hi": ("max", "id"), "m": ("mean", "v")}


def plain_rolled(data, width):
    out = {}
    for t, k, i, _ in data:
        near = [(j, v) for u, k2, j, v in data if k2 == k and t is not None and u is not None and t - width <= u <= t]
        values = [v for _, v in near if v is not None]
        out[i] = (sum(values) if values else None, len(values), min((j for j, _ in near), default=None),
                  max((j for j, _ in near), default=None), sum(values) / len(values) if values else None)
        if t is None:
            out[i] = (None,) * 5
    return out


@pytest.mark.parametrize(
    "options, hours",
    [({}, 5), ({"hot_rows": 3, "splits": 2}, 1), ({"hot_rows": 1, "splits": 60}, 5),
     ({"hot_rows": 20, "splits": 7}, 200)],
)
def test_rolled_aggregates(spark, rows, options, hours):
    more = [*rows, (None, "a", 900, 5), (None, None, 901, None), (-31, "a", 902, 4), (-30, "a", 903, None)]
    data = [(None if t is None else START + dt.timedelta(hours=t), k, i, v) for t, k, i, v in more]
    df = spark.createDataFrame(data, "`$timestamp` timestamp_ntz, k string, id bigint, v bigint").repartition(3)
    got = ts.rolled_within(df, ROLLED, f"{hours}h", on=["k"], **options)
    assert got.columns == [*df.columns, *ROLLED]
    assert {r.id: tuple(r[c] for c in ROLLED) for r in got.collect()} == plain_rolled(more, hours)


def test_rolled_aggregates_of_a_crowded_instant(spark):
    df = crowd(spark, 600, 30)
    hot = {"on": ["k"], "hot_rows": 5, "splits": 8}
    data = [((r["$timestamp"] - START) // dt.timedelta(hours=1), r.k, n, r.v) for n, r in enumerate(df.collect())]
    for hours in (1, 3, 50):
        got = ts.rolled_within(df, {"s": ("sum", "v"), "c": ("count", "id")}, f"{hours}h", **hot).collect()
        plain = plain_rolled(data, hours)
        assert sorted((r.s, r.c) for r in got) == sorted((s, c) for s, c, *_ in plain.values())
    with pytest.raises(ValueError, match="mode"):
        ts.rolled_within(df, {"s": ("mode", "v")}, "1h", **hot)


def test_segments_of_rolled_aggregates_are_even(spark):
    """No segment has more than about twice its share, whatever one key or instant holds."""
    from tickshard.operators import running

    df = crowd(spark, 4000, 30).withColumn("k", F.lit("a"))
    seen = []
    plain = running.with_segment

    def watched(*args, **options):
        found = plain(*args, **options)
        seen.append(found)
        return found

    running.with_segment = watched
    try:
        ts.rolled_within(df, {"s": ("sum", "v")}, "40h", on=["k"], hot_rows=50, splits=8)
    finally:
        running.with_segment = plain
    for placed in seen[::2]:  # those of the rows; steps have one row for each instant
        sizes = [r["count"] for r in placed.groupBy("hot", "segment").count().collect()]
        assert max(sizes) <= 2 * (2 * 4210) / 8  # each row asks in two blocks


def test_other_keys_take_one_row_each(spark, rows):
    plan = ts.counted_within(frame(spark, rows), "n", "5h", on=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
