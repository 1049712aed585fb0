"""The time axis: find it, type it, cut it by half-open ranges."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import instant_literal, instant_micros, require_utc
from tickshard.names import AXIS, SHARD


def or_fail(value: Column, source: Column, message: str) -> Column:
    """*value*, or a failed job where *source* holds something *value* could not take.

    *value* is evaluated once; the check runs only for rows where it is NULL.
    """
    failure = F.raise_error(F.concat(F.lit(message + ": "), source.cast("string")))
    return F.coalesce(value, F.when(source.isNotNull(), failure))


def normalize_axis(df: DataFrame, column: str | None = None) -> DataFrame:
    """Make ``$timestamp`` a ``TIMESTAMP_NTZ`` column.

    *column* names the axis when it is called something else. Zoned timestamps
    are kept as UTC wall time; texts are parsed, and a text that is no timestamp
    fails the job when it runs. A frame without an axis is a ``ValueError``.
    """
    if column is not None and column != AXIS:
        if AXIS in df.columns:
            raise ValueError(f"the frame has both {AXIS!r} and the named axis {column!r}")
        df = df.withColumnRenamed(column, AXIS)
    if AXIS not in df.columns:
        raise ValueError(f"the frame has no {AXIS!r} column; columns are {df.columns}")

    kind = df.schema[AXIS].dataType
    axis = F.col(AXIS)
    if isinstance(kind, T.TimestampNTZType):
        return df
    if isinstance(kind, (T.TimestampType, T.StringType)):
        require_utc(df.sparkSession)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return df.withColumn(AXIS, axis.cast("timestamp_ntz"))
    if isinstance(kind, T.StringType):
        parsed = axis.try_cast("timestamp_ltz").cast("timestamp_ntz")
        return df.withColumn(AXIS, or_fail(parsed, axis, "not a timestamp"))
    raise TypeError(f"{AXIS!r} cannot be a time axis: its type is {kind.simpleString()}")


def merged_ranges(ranges: Iterable[tuple]) -> list[tuple[int, int]]:
    """Half-open ranges in microseconds, sorted; empty ones dropped, touching ones joined."""
    spans = sorted((instant_micros(lo), instant_micros(hi)) for lo, hi in ranges)
    merged: list[tuple[int, int]] = []
    for lo, hi in spans:
        if hi <= lo:
            continue
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def any_of(predicates: list[Column]) -> Column:
    """A disjunction as a balanced tree, so that long lists are not deep."""
    if not predicates:
        return F.lit(False)
    while len(predicates) > 1:
        pairs = zip(predicates[::2], predicates[1::2])
        odd = predicates[-1:] if len(predicates) % 2 else []
        predicates = [a | b for a, b in pairs] + odd
    return predicates[0]


def in_runs(runs: Iterable[tuple[int, int]]) -> Column:
    """Partition filter for closed *runs* of shard numbers; runs that touch become one,
    and single shards enter one list of numbers."""
    joined: list[list[int]] = []
    for first, last in sorted(runs):
        if joined and first <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], last)
        else:
            joined.append([first, last])
    listed = [first for first, last in joined if first == last]
    spans = [F.col(SHARD).between(*run) for run in joined if run[0] < run[1]]
    return any_of([F.col(SHARD).isin(listed), *spans] if listed else spans)


def shards_of(ranges: list[tuple[int, int]], shard_width: int) -> Column:
    return in_runs((lo // shard_width, (hi - 1) // shard_width) for lo, hi in ranges)


def within(ranges: list[tuple[int, int]], shard_width: int | None = None) -> Column:
    """Predicate "the axis lies in one of *ranges*".

    Spark derives no partition filter from a predicate on the axis alone, so the
    matching predicate on the shard number is added when the width is known.
    """
    axis = F.col(AXIS)
    predicate = any_of(
        [(axis >= instant_literal(lo)) & (axis < instant_literal(hi)) for lo, hi in ranges]
    )
    return predicate if shard_width is None else shards_of(ranges, shard_width) & predicate


def time_range(df: DataFrame, lo, hi) -> DataFrame:
    """Rows with ``lo <= $timestamp < hi``; the filter reaches the scan."""
    return df.where(within(merged_ranges([(lo, hi)])))
