"""Aggregates per time bucket."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickshard.functions.clock import div, floor_to, from_micros, micros, width_micros
from tickshard.names import AXIS
from tickshard.operators.schema import named


def bucket_agg(df: DataFrame, width: str | int | dt.timedelta, *aggregates: Column) -> DataFrame:
    """Aggregates per bucket; ``$timestamp`` of the result is the bucket's start.

    Buckets are multiples of *width* from 1970-01-01 UTC, also before it. Only
    buckets that hold rows appear. The key is one timestamp and aggregation is
    partial before the shuffle, so what moves is one row per task and bucket
    however many rows fall into a single bucket. ``window`` works on NTZ time as it
    is, without a detour over the session zone.
    """
    start = F.window(F.col(AXIS), f"{width_micros(width)} microseconds").getField("start")
    counted = df.where(F.col(AXIS).isNotNull()).groupBy(start.alias("bucket")).agg(*aggregates)
    values = [named(c) for c in counted.columns if c != "bucket"]
    return counted.select(F.col("bucket").alias(AXIS), *values)


def bucket_count(df: DataFrame, width: str | int | dt.timedelta, *columns: str) -> DataFrame:
    """Non-missing values per bucket, one ``count(column)`` for each column."""
    counts = [F.count(named(c)).alias(f"count({c})") for c in columns]
    return bucket_agg(df, width, *counts)


#: Buckets that are made together, as the rows of one stretch of a key.
STRETCH = 4096


def bucket_filled(
    df: DataFrame,
    width: str | int | dt.timedelta,
    *columns: str,
    on: Sequence[str] = (),
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """*on*, ``$timestamp``, ``count(column)`` for each of *columns* and the columns of *carry*
    for every bucket from the first to the last of each key, empty ones with counts of 0.

    *carry* maps new names to columns: the last value of the column in the bucket or before
    it, by time and then by value; NULLs are passed over. Without *on* all rows are one key.

    A key's span is cut into stretches of STRETCH buckets. Empty buckets are made stretch by
    stretch on the executors, and what a stretch takes over is found over one row for each
    stretch, so no task gets a whole span.
    """
    wide, carry = width_micros(width), dict(carry or {})
    keys = [f"k{i}" for i in range(len(on))]
    counts = [f"n{i}" for i in range(len(columns))]
    lasts = [f"v{i}" for i in range(len(carry))]
    time = micros()
    rows = df.where(F.col(AXIS).isNotNull()).select(
        *[named(k).alias(name) for k, name in zip(on, keys)],
        div(floor_to(time, wide), wide).alias("b"),
        *[named(c).isNotNull().alias(name) for c, name in zip(columns, counts)],
        *[
            F.when(named(c).isNotNull(), F.struct(time.alias("t"), named(c).alias("v"))).alias(name)
            for c, name in zip(carry.values(), lasts)
        ],
    )
    held = rows.groupBy(*keys, "b").agg(
        F.lit(_HELD).alias("kind"), *[F.count_if(n).alias(n) for n in counts], *[F.max(v).alias(v) for v in lasts]
    )
    held = held.withColumn("stretch", div(floor_to(F.col("b"), STRETCH), STRETCH))

    spans = held.groupBy(*keys).agg(F.min("b").alias("low"), F.max("b").alias("high"))
    ends = [div(floor_to(F.col(c), STRETCH), STRETCH) for c in ("low", "high")]
    stretches = spans.select("*", F.explode(F.sequence(*ends)).alias("stretch"))
    first = F.col("stretch") * STRETCH
    inside = F.sequence(
        F.greatest(first, F.col("low")), F.least(first + (STRETCH - 1), F.col("high"))
    )
    spread = stretches.repartition(*keys, "stretch") if keys else stretches.repartition("stretch")
    blank = spread.select(*keys, "stretch", F.explode(inside).alias("b"), F.lit(_BLANK).alias("kind"))
    parts = [held, blank]
    if lasts:
        # one row for each stretch: what it holds last, and what those before it hold
        own = held.groupBy(*keys, "stretch").agg(*[F.max(v).alias(v) for v in lasts])
        every = own.unionByName(stretches.select(*keys, "stretch"), allowMissingColumns=True)
        every = every.groupBy(*keys, "stretch").agg(*[F.max(v).alias(v) for v in lasts])
        before = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        seeds = every.withColumns({v: F.max(v).over(before) for v in lasts})
        parts.append(seeds.withColumns({"b": F.col("stretch") * STRETCH - 1, "kind": F.lit(_SEED)}))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part, allowMissingColumns=True)

    in_order = Window.partitionBy(*keys, "stretch").orderBy("b", "kind")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = together.withColumns(
        {"again": F.lag("b").over(in_order) == F.col("b"), **{v: F.max(v).over(upto) for v in lasts}}
    )
    kept = (F.col("kind") == _HELD) | (F.col("kind") == _BLANK) & ~F.coalesce("again", F.lit(False))
    return filled.where(kept).select(
        *[F.col(name).alias(k) for k, name in zip(on, keys)],
        from_micros(F.col("b") * wide).alias(AXIS),
        *[F.coalesce(n, F.lit(0)).alias(f"count({c})") for c, n in zip(columns, counts)],
        *[F.col(v).getField("v").alias(new) for new, v in zip(carry, lasts)],
    )


_SEED, _HELD, _BLANK = 0, 1, 2  # order of rows of one bucket
