"""Random sequences of writes against a model that keeps the table as a list."""

import datetime as dt
import random
from collections import Counter

import pytest

import tickshard as ts
from tickshard.plans.snapshots import stored_shards
from tickshard.plans.tables import shard_width

COLUMNS = ("$timestamp", "id", "v")
START = dt.datetime(1969, 12, 30)


def low(value):
    """Orders NULL below every value, as Spark does."""
    return (value is not None, value)


def collapsed(batch, keys):
    best = {}
    for row in batch:
        key = tuple(row[COLUMNS.index(k)] for k in keys)
        rest = tuple(low(v) for c, v in zip(COLUMNS, row) if c not in keys)
        if key not in best or rest > best[key][0]:
            best[key] = (rest, row)
    return {key: row for key, (_, row) in best.items()}


def apply(stored, batch, options):
    keys = options.get("deduplicate")
    keys = list(COLUMNS) if keys is True else keys
    fresh = collapsed(batch, keys) if keys else None
    rows = list(fresh.values()) if keys else batch
    if options.get("push_mode") == "truncate":
        if not rows:
            return stored
        lo, hi = min(r[0] for r in rows), max(r[0] for r in rows)
        return [r for r in stored if not lo <= r[0] <= hi] + rows
    if not keys:
        return stored + rows
    key = lambda r: tuple(r[COLUMNS.index(k)] for k in keys)
    if options.get("deduplication_mode") == "upsert":
        return [r for r in stored if key(r) not in fresh] + rows
    present = {key(r) for r in stored}
    return stored + [r for r in rows if key(r) not in present]


@pytest.mark.parametrize("seed", range(4))
def test_tables_follow_the_model(spark, table_name, seed):
    rng = random.Random(seed)
    width = rng.choice(["6h", "1d", "3d"])
    stored = []
    for step in range(7):
        batch = [
            (START + dt.timedelta(hours=rng.randrange(0, 96)), rng.choice([None, *range(6)]), rng.choice([None, 1, 2]))
            for _ in range(rng.choice([0, 1, 5, 15]))
        ]
        batch += rng.sample(batch, len(batch) // 3)
        options = rng.choice([
            {}, {"push_mode": "transactional"}, {"push_mode": "truncate"},
            {"push_mode": "truncate", "deduplicate": ["id"]}, {"cluster": False},
            *[{"deduplicate": k, "deduplication_mode": m}
              for k in (True, ["id"], ["$timestamp", "id"]) for m in ("drop", "upsert")],
        ])
        df = spark.createDataFrame(batch, "`$timestamp` timestamp_ntz, id bigint, v bigint")
        ts.write_dataframe(df, table_name, shard_size=None if step else width, **options).compute()
        stored = apply(stored, batch, options)
        got = Counter(map(tuple, ts.read_table(spark, table_name).collect()))
        assert got == Counter(stored), (step, options)
    micros = shard_width(spark, table_name)
    epoch = dt.datetime(1970, 1, 1)
    shards = {(r[0] - epoch) // dt.timedelta(microseconds=1) // micros for r in stored}
    assert set(stored_shards(spark, table_name)) == shards
