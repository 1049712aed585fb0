"""As-of join against brute force on small frames, with and without segments."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.operators.segments import find_hot_keys

START = dt.datetime(2024, 1, 1)
LEFT = "`$timestamp` timestamp_ntz, k string, id bigint"
RIGHT = "`$timestamp` timestamp_ntz, k string, v bigint"


def at(micros):
    return None if micros is None else START + dt.timedelta(microseconds=micros)


def brute(left, right, keyed):
    out = []
    for t, k, i in left:
        best = None
        for rt, rk, v in right:
            if t is None or rt is None or rt > t or (keyed and (k is None or rk != k)):
                continue
            if best is None or (rt, v) > best:
                best = (rt, v)
        out.append((i, best))
    return sorted(out)


def joined(spark, left, right, keyed, **options):
    l = spark.createDataFrame([(at(t), k, i) for t, k, i in left], LEFT).repartition(5)
    r = spark.createDataFrame([(at(t), k, v) for t, k, v in right], RIGHT).repartition(3)
    if not keyed:
        r = r.drop("k")
    df = ts.asof_join(l, r, on=["k"] if keyed else [], **options)
    assert df.columns == ["$timestamp", "k", "id", "matched_at", "v"]
    return sorted(
        (row.id, None if row.matched_at is None else ((row.matched_at - START) // dt.timedelta(microseconds=1), row.v))
        for row in df.collect()
    )


def sample(seed):
    rng = random.Random(seed)
    keys = ["a"] * 6 + ["b", "c", None]
    times = [rng.randrange(0, 60) for _ in range(20)] + [7] * 25
    left = [(rng.choice(times), rng.choice(keys), i) for i in range(120)] + [(None, "a", 500)]
    right = [(rng.choice(times) + rng.choice([0, 1]), rng.choice(keys + ["d"]), rng.randrange(9)) for _ in range(90)]
    return left, right + [(None, "a", 1)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("splits", [None, 2, 5, 40])
def test_against_brute_force(spark, seed, keyed, splits):
    left, right = sample(seed)
    options = {} if splits is None else {"hot_rows": 3, "splits": splits}
    assert joined(spark, left, right, keyed, **options) == brute(left, right, keyed)


def test_one_instant_holds_everything(spark):
    """All rows at one time and key: segments share the left, the winner reaches each."""
    left = [(9, "a", i) for i in range(200)]
    right = [(9, "a", v % 50) for v in range(300)]
    assert joined(spark, left, right, True, hot_rows=10, splits=8) == [(i, (9, 49)) for i in range(200)]


def test_no_earlier_right_row(spark):
    assert joined(spark, [(5, "a", 1)], [(6, "a", 1), (1, "b", 2)], True) == [(1, None)]
    assert joined(spark, [(5, "a", 1)], [], False) == [(1, None)]
    assert joined(spark, [], [(1, "a", 1)], True) == []


def test_equal_time_matches_and_tie_columns_decide(spark):
    left = spark.createDataFrame([(at(5), "a", 1)], LEFT)
    right = spark.createDataFrame([(at(5), "a", 3, 1.0), (at(5), "a", 2, 9.0)], RIGHT + ", w double")
    assert ts.asof_join(left, right, on=["k"]).first().v == 3
    assert ts.asof_join(left, right, on=["k"], tie=["w"]).first().v == 2


def test_names_that_clash_get_the_suffix(spark):
    left = spark.createDataFrame([(at(5), "a", 1)], LEFT)
    right = spark.createDataFrame([(at(4), "a", 7)], LEFT)
    df = ts.asof_join(left, right, on=["k"], suffix="_r", matched_at="seen")
    assert df.columns == ["$timestamp", "k", "id", "seen", "id_r"] and df.first().id_r == 7


def test_hot_keys_are_few_and_their_segments_even(spark):
    times = spark.range(100_000).select(
        F.when(F.col("id") < 40_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("k0"),
        F.col("id").alias("t"),
    )
    hot = find_hot_keys(times, ["k0"], 500, 50)
    assert [r.k0 for r in hot.table.collect()] == ["hot"]
    assert 18 <= hot.segment_count(0) <= 22
    cuts = [0, *hot.cuts[0], 40_000]
    assert all(1000 < b - a < 3000 for a, b in zip(cuts, cuts[1:]))
    assert find_hot_keys(times, ["k0"], 50_000, 50) is None
    assert find_hot_keys(times, [], 50_000, 50).segment_count(0) in (2, 3)
    assert find_hot_keys(times, [], 100_000, 50) is None


def test_no_key_needs_the_search_for_hot_keys(spark):
    left = spark.createDataFrame([(at(5), "a", 1)], LEFT)
    with pytest.raises(ValueError, match="hot_rows"):
        ts.asof_join(left, left, hot_rows=None)


def test_two_tables_are_two_scans(spark, tmp_path):
    """Also where keys are hot and instants crowded; what segments take over is no third scan."""
    at = F.timestamp_seconds(F.col("id") % 40 * 60).cast("timestamp_ntz").alias("$timestamp")
    for side, n in (("left", 3000), ("right", 2000)):
        rows = spark.range(n).select(at, (F.col("id") % 3).alias("k"), F.col("id").alias(side))
        rows.write.parquet(str(tmp_path / side))
    left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
    joined = ts.asof_join(left, right, on=["k"], tie=["right"], hot_rows=20, splits=64)
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan
    best = {}
    for r in right.collect():
        best.setdefault((r.k, r["$timestamp"]), []).append(r.right)
    for r in joined.collect():
        assert r.right == max(best[r.k, r["$timestamp"]]) and r.matched_at == r["$timestamp"]


def test_maps_at_any_depth_are_payload(spark):
    start = "TIMESTAMP_NTZ '2024-01-01'"
    left = spark.sql(f"SELECT {start} + make_dt_interval(0, id) AS `$timestamp`, id AS x FROM range(6)")
    right = spark.sql(f"""
        SELECT {start} + make_dt_interval(0, id * 2) AS `$timestamp`, map('a', id) AS m,
               if(id = 1, NULL, struct(map('k', array(map('z', id), map())) AS deep, id AS n)) AS s
        FROM range(3) UNION ALL SELECT {start}, map('a', -1), NULL""")
    for hot_rows in (1, 5_000_000):
        found = {r.x: (r.m["a"], r.s and (r.s.deep["k"][0]["z"], r.s.deep["k"][1], r.s.n))
                 for r in ts.asof_join(left, right, hot_rows=hot_rows, splits=4).collect()}
        assert found == {0: (0, (0, {}, 0)), 1: (0, (0, {}, 0)), 2: (1, None), 3: (1, None),
                         4: (2, (2, {}, 2)), 5: (2, (2, {}, 2))}
