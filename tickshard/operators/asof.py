"""As-of join: every left row with the latest right row that is not after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import micros, require_utc
from tickshard.names import AXIS
from tickshard.operators.schema import named
from tickshard.operators.segments import (
    BEFORE_ALL,
    HOT_ROWS,
    HotKeys,
    carried,
    default_splits,
    find_hot_keys,
    with_hot_number,
    with_segment,
)

_CARRIED, _RIGHT, _LEFT = -1, 0, 1  # order of rows at one instant


def _key_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [named(k).alias(f"k{i}") for i, k in enumerate(keys)]


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _ordered(column: Column, kind: T.DataType) -> Column:
    """*column* with its maps, at any depth, as their sorted entries: maps have no order."""
    if not _has_map(kind):
        return column
    if isinstance(kind, T.StructType):
        fields = [_ordered(column.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind)]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _ordered(x, kind.elementType))
    entry = lambda e: F.struct(e["key"].alias("key"), _ordered(e["value"], kind.valueType).alias("value"))
    return F.sort_array(F.transform(F.map_entries(column), entry))


def _restored(column: Column, kind: T.DataType) -> Column:
    """What ``_ordered`` was made from."""
    if not _has_map(kind):
        return column
    if isinstance(kind, T.StructType):
        fields = [_restored(column.getField(f"f{i}"), f.dataType).alias(f.name) for i, f in enumerate(kind)]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _restored(x, kind.elementType))
    entry = lambda e: F.struct(e["key"].alias("key"), _restored(e["value"], kind.valueType).alias("value"))
    return F.map_from_entries(F.transform(column, entry))


def _seeds(right: DataFrame, hot_keys: HotKeys, keys: list[str]) -> DataFrame:
    """For each segment of a hot key, the last right row of the segments before it.
    The right side shrinks to one row per segment before anything moves."""
    last = (
        right.where("hot >= 0")
        .groupBy("hot", "segment")
        .agg(F.max(F.struct("t", "r")).alias("value"))
    )
    seeds = carried(last, hot_keys, lambda c: F.last(c, ignorenulls=True))
    if hot_keys.table is not None:
        seeds = seeds.join(F.broadcast(hot_keys.table), "hot")
    return seeds.select(
        *keys,
        F.lit(BEFORE_ALL).alias("t"),
        F.lit(_CARRIED).alias("side"),
        F.col("carried.r").alias("r"),
        "hot",
        "segment",
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    on: Sequence[str] = (),
    tie: Sequence[str] = (),
    suffix: str = "_right",
    matched_at: str = "matched_at",
    hot_rows: int | None = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """Left outer as-of join on ``$timestamp``, backward and inclusive.

    on
        Columns that must be equal as well; NULL equals nothing. May be empty.
    tie
        Right columns that decide between right rows at one instant: the greatest
        wins. The remaining columns decide after them, so the result is the same
        on every run.
    suffix, matched_at
        Right columns keep their names, with *suffix* where the left has the name;
        the right row's time is *matched_at*.
    hot_rows, splits
        A key with more than *hot_rows* rows and more than one *splits*-th of all
        rows is cut into time segments (``tickshard.operators.segments``). Looking
        for those keys counts the rows, and samples them if they are many;
        ``hot_rows=None`` skips it for keys known to be small.

    Both sides move by key and segment, and each left row takes the last right row before it
    in its segment: no pairs are formed. The last right row of earlier segments enters each
    segment as one extra row. Where there are hot keys, right rows of one key and instant are
    folded into the winner before.
    """
    require_utc(left.sparkSession)
    if hot_rows is None and not on:
        raise ValueError("hot_rows=None needs key columns: without them all rows are one key")
    splits = default_splits(left) if splits is None else splits
    keys = [f"k{i}" for i in range(len(on))]

    others = [c for c in right.columns if c not in on and c != AXIS]
    others = [*tie, *[c for c in others if c not in tie]]
    kinds = {c: right.schema[c].dataType for c in others}
    payload = F.struct(
        *[_ordered(named(c), kinds[c]).alias(f"c{i}") for i, c in enumerate(others)],
        named(AXIS).alias("at"),
    )
    usable = named(AXIS).isNotNull()
    for key in on:
        usable = usable & named(key).isNotNull()

    right_rows = right.where(usable).select(
        *_key_columns(right, on),
        micros().alias("t"),
        F.lit(_RIGHT).alias("side"),
        payload.alias("r"),
    )
    left_rows = left.select(
        *_key_columns(left, on),
        F.coalesce(micros(), F.lit(BEFORE_ALL)).alias("t"),
        F.lit(_LEFT).alias("side"),
        F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(left.columns)]).alias("l"),
    )

    times = left_rows.select(*keys, "t").unionByName(right_rows.select(*keys, "t"))
    hot_keys = None if hot_rows is None else find_hot_keys(times, keys, hot_rows, splits)
    groups = list(keys)
    sides = [left_rows, right_rows]
    if hot_keys is not None:
        groups += ["hot", "segment"]
        left_rows = with_hot_number(left_rows, hot_keys, keys)
        # the winner of each instant first: an instant moves as one row, and what segments
        # take over comes from the same shuffled rows
        folded = right_rows.groupBy(*keys, "t", "side").agg(F.max("r").alias("r"))
        placed = with_segment(with_hot_number(folded, hot_keys, keys), hot_keys, spread=False)
        sides = [
            with_segment(left_rows, hot_keys, spread=True),
            placed,
            _seeds(placed, hot_keys, keys),
        ]
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side, allowMissingColumns=True)

    upto = Window.partitionBy(*groups).orderBy("t", "side", "r")
    matched = rows.withColumn("m", F.last("r", ignorenulls=True).over(
        upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )).where(F.col("side") == _LEFT)

    found = F.when(F.col("t") > BEFORE_ALL, F.col("m"))
    taken = set(left.columns)
    return matched.select(
        *[F.col("l").getField(f"c{i}").alias(c) for i, c in enumerate(left.columns)],
        found.getField("at").alias(matched_at),
        *[
            _restored(found.getField(f"c{i}"), kinds[c]).alias(c + suffix if c in taken else c)
            for i, c in enumerate(others)
        ],
    )
