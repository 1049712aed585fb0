"""Even cuts of the time axis, in exact integer arithmetic.

``n`` slices cover ``[min, max + 1us)`` with bounds ``lo_i = min + floor(i * span / n)``.
A row at offset ``r`` from ``min`` lies in the last slice whose bound is not above
it, which is ``((r + 1) * n - 1) div span``. Products are decimals, so no span or
``n`` rounds a bound, and slices that share a bound stay empty and lose nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickshard.functions.clock import div, from_micros, micros, require_utc
from tickshard.names import AXIS, SLICE

_EXTENT = "$extent"


def check_count(n: int) -> int:
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        raise ValueError(f"the number of slices must be a positive integer; got {n!r}")
    return n


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _extent(df: DataFrame) -> DataFrame:
    """One row: first instant and length of the axis, in microseconds."""
    first, last = F.min(AXIS), F.max(AXIS)
    return df.agg(
        micros(first).alias("first"), (micros(last) - micros(first) + 1).alias("span")
    )


def slice_number(first: Column, span: Column, n: int) -> Column:
    offset = _wide(micros() - first) + 1
    number = div(offset * F.lit(n).cast("decimal(10,0)") - 1, _wide(span))
    return F.coalesce(number.cast("int"), F.lit(0))


def slice_bounds(df: DataFrame, n: int) -> DataFrame:
    """``slice, lo, hi`` for the *n* half-open slices; no rows for an empty frame."""
    require_utc(df.sparkSession)
    check_count(n)
    extent = _extent(df).where(F.col("span").isNotNull())

    def bound(i: Column) -> Column:
        step = div(_wide(i) * _wide(F.col("span")), F.lit(n).cast("decimal(10,0)"))
        return from_micros(F.col("first") + step.cast("bigint"))

    numbered = extent.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    i = F.col("slice")
    return numbered.select(i, bound(i).alias("lo"), bound(i + 1).alias("hi"))


def with_slice(df: DataFrame, n: int, name: str = SLICE) -> DataFrame:
    """*df* with its slice number (0..n-1) as column *name*; no shuffle, no action.

    The extent is a scalar subquery, so rows see two constants. A row without a
    time counts to slice 0.
    """
    require_utc(df.sparkSession)
    check_count(n)
    extent = _extent(df).select(F.struct("first", "span")).scalar()
    first, span = F.col(_EXTENT).getField("first"), F.col(_EXTENT).getField("span")
    numbered = df.withColumn(_EXTENT, extent).withColumn(name, slice_number(first, span, n))
    return numbered.drop(_EXTENT)


def slice_parts(df: DataFrame, number: Column, n: int, split_rows: int | None) -> list[int]:
    """Into how many partitions each slice goes: one, unless the caller wants slices
    above *split_rows* rows split. Then a count per slice (n rows) tells."""
    parts = [1] * n
    if split_rows is not None:
        for row in df.groupBy(number.alias(SLICE)).count().collect():
            parts[row[SLICE]] = -(-row["count"] // split_rows)
    return parts


def partition_by_slice(
    df: DataFrame,
    n: int,
    split_rows: int | None = None,
    extent: tuple[int, int] | None = None,
) -> DataFrame:
    """*df* as *n* Spark partitions, one per slice, in time order and sorted inside.

    Partition ``i`` is slice ``i`` whatever the size; rows without a time are in slice 0.
    With *split_rows* a slice above so many rows is dealt in turn over as many
    neighbouring partitions as it needs, which also parts equal rows and the rows of one
    task. *extent* is the first instant and the length of the axis, where known.
    """
    require_utc(df.sparkSession)
    check_count(n)
    first, span = extent or _extent(df).first()
    if span is None:
        return df.repartitionById(n, F.lit(0))
    number = slice_number(F.lit(first), F.lit(span), n)
    parts = slice_parts(df, number, n, split_rows)
    if max(parts) == 1:
        return df.repartitionById(n, number).sortWithinPartitions(AXIS)

    starts = [sum(parts[:i]) for i in range(n)]
    start, width = F.lit(starts)[number], F.lit(parts)[number]
    target = (start + F.pmod(F.monotonically_increasing_id(), width)).cast("int")
    placed = df.withColumn("$part", target).repartitionById(sum(parts), F.col("$part"))
    return placed.drop("$part").sortWithinPartitions(AXIS)
