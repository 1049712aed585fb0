"""Reading stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickshard.functions.clock import instant_micros, micros
from tickshard.names import AXIS, SHARD
from tickshard.operators.axis import merged_ranges, within
from tickshard.operators.schema import hide_internal, named
from tickshard.operators.segments import BEFORE_ALL
from tickshard.operators.slices import (
    check_count,
    partition_by_slice,
    slice_number,
    slice_parts,
)
from tickshard.plans.snapshots import stored_shards
from tickshard.plans.tables import in_shards, raw_table, shard_width

# Longer lists of ranges are searched instead of compared one by one; the rows are the same.
RANGES_IN_FILTER = 200


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A stored table without its internal columns."""
    return hide_internal(raw_table(spark, table))


def read_ranges(
    spark: SparkSession,
    *,
    table: str,
    ranges: Iterable[tuple],
    column_names: Sequence[str] | None = None,
) -> DataFrame:
    """``$timestamp`` and *column_names* of the rows in any of the half-open *ranges*.

    Only the shards the ranges touch are listed and read, and inside them the time
    predicate reaches the row groups. Overlapping ranges give a row once.
    """
    spans = merged_ranges(ranges)
    width = shard_width(spark, table)
    rows = raw_table(spark, table)
    if len(spans) <= RANGES_IN_FILTER:
        rows = rows.where(within(spans, width))
    else:
        held = (s for s in stored_shards(spark, table) if s is not None)
        rows = _in_listed_ranges(rows.where(in_shards(_touched(held, spans, width))), spans, width)
    if column_names is None:
        return hide_internal(rows)
    return rows.select([named(c) for c in dict.fromkeys((AXIS, *column_names))])


def _in_listed_ranges(rows: DataFrame, spans: list[tuple[int, int]], width: int) -> DataFrame:
    """Rows in one of many disjoint ranges: each looks up the last range that starts before
    it. Shards that no range touches are not opened, and the time filter of the whole extent
    still reaches the scan. Sixteen bytes for each range go to the tasks."""
    lows, highs = (np.array(ends, dtype="int64") for ends in zip(*spans))
    shared = rows.sparkSession.sparkContext.broadcast((lows, highs))

    @F.pandas_udf("boolean")
    def inside(t: pd.Series) -> pd.Series:
        lows, highs = shared.value
        times = t.to_numpy()
        last = np.searchsorted(lows, times, side="right") - 1
        return pd.Series((last >= 0) & (times < highs[last]))

    whole = within([(spans[0][0], spans[-1][1])])
    return rows.where(whole).where(inside(F.coalesce(micros(), F.lit(BEFORE_ALL))))


def _touched(shards: Iterable[int], spans: list[tuple[int, int]], width: int) -> list[int]:
    """Those of *shards* that one of the sorted, disjoint *spans* reaches into."""
    numbers = np.array(sorted(shards), dtype="int64")
    lows, highs = (np.array(ends, dtype="int64") for ends in zip(*spans))
    first = np.searchsorted((highs - 1) // width, numbers, side="left")  # ends in it or later
    starts = np.append(lows // width, np.iinfo("int64").max)
    return numbers[starts[first] <= numbers].tolist()


def read_request(spark: SparkSession, request: Mapping) -> DataFrame:
    """``read_ranges`` for a request that arrives as a mapping with the keys ``table``,
    ``ranges`` and ``column_names``; a key that is not there is a ``KeyError``."""
    wanted = ("table", "ranges", "column_names")
    missing = [key for key in wanted if key not in request]
    if missing:
        raise KeyError(f"the read request has no {', '.join(missing)}")
    return read_ranges(spark, **{key: request[key] for key in wanted})


def _table_extent(spark: SparkSession, table: str) -> tuple[int, int] | None:
    """First and last instant of a table. The first is in its first shard and the last
    in its last, so two shards are read however many there are."""
    shards = stored_shards(spark, table)
    if not shards or None in shards:
        return None
    edges = raw_table(spark, table).where(F.col(SHARD).isin(min(shards), max(shards)))
    first, last = edges.agg(F.min(AXIS), F.max(AXIS)).first()
    return None if first is None else (instant_micros(first), instant_micros(last))


def read_slices(
    spark: SparkSession,
    *,
    table: str,
    npartitions: int,
    column_names: Sequence[str] | None = None,
    split_rows: int | None = None,
    scans: bool = False,
) -> DataFrame:
    """A stored table as *npartitions* even time slices, one Spark partition each, in
    time order and sorted inside.

    With *scans* no row is shuffled: a slice is a range read that opens the shards it
    touches, and costs one scan to plan. That pays for few slices of a large table;
    otherwise the table is cut by one shuffle. With *split_rows* a slice above so many
    rows is read by several tasks, and partition numbers are slice numbers no more.
    """
    check_count(npartitions)
    stored = raw_table(spark, table)
    if column_names is None:
        columns = [named(c) for c in hide_internal(stored).columns]
    else:
        columns = [named(c) for c in dict.fromkeys((AXIS, *column_names))]
    extent = _table_extent(spark, table)
    first, span = (0, 0) if extent is None else (extent[0], extent[1] - extent[0] + 1)
    if not scans or span < npartitions:
        return partition_by_slice(
            stored.select(columns), npartitions, split_rows, extent and (first, span)
        )

    width = shard_width(spark, table)
    number = slice_number(F.lit(first), F.lit(span), npartitions)
    parts = slice_parts(stored, number, npartitions, split_rows)

    # Spark merges a union of single partitions into one partition. An empty scan, of a
    # shard before the first, keeps the slices apart and adds no partition.
    slices = [stored.where(F.col(SHARD) == first // width - 1).select(columns)]
    for i, tasks in enumerate(parts):
        lo, hi = first + i * span // npartitions, first + (i + 1) * span // npartitions
        part = stored.where(within([(lo, hi)], width)).select(columns)
        slices.append(part.coalesce(tasks).sortWithinPartitions(AXIS))
    return reduce(DataFrame.unionAll, slices)
