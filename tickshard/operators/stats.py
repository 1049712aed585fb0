"""Whole-frame sum, mean and sample deviation, also as columns on every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.missing import nan_to_null
from tickshard.operators.schema import named

_STATS = "$stats"


def _measures(df: DataFrame, column: str) -> list[Column]:
    value = named(column)
    whole = isinstance(df.select(value).schema[0].dataType, T.IntegralType)
    total = F.sum(value.cast("decimal(38,0)")) if whole else F.sum(value)
    return [
        F.coalesce(total, F.lit(0).cast("decimal(38,0)") if whole else F.lit(0)).alias(
            f"sum_{column}"
        ),
        F.avg(value).alias(f"mean_{column}"),
        F.stddev_samp(value).alias(f"std_{column}"),
    ]


def global_stats(df: DataFrame, *columns: str) -> DataFrame:
    """One row with ``sum_c``, ``mean_c`` and ``std_c`` for each column.

    Missing values (NULL and NaN) are skipped. A sum over nothing is 0; a mean
    over nothing and a deviation of fewer than two values are NULL. Sums of integers are
    ``decimal(38,0)``, which no table of 64-bit integers can overflow.
    """
    measures = [m for c in columns for m in _measures(df, c)]
    return nan_to_null(df, *columns).agg(*measures)


def with_global_stats(df: DataFrame, *columns: str, stats: DataFrame | None = None) -> DataFrame:
    """*df* with the statistics of the whole frame on every row.

    *stats* is the row of statistics if it is known, as from ``stored_stats``.

    The statistics are one scalar subquery: a single pass with partial
    aggregation whose one-row result enters the projection as a constant. Rows
    are neither shuffled nor joined.
    """
    stats = global_stats(df, *columns) if stats is None else stats
    row = stats.select(F.struct(*[named(c) for c in stats.columns])).scalar()
    extended = df.withColumn(_STATS, row)
    values = [F.col(_STATS).getField(c).alias(c) for c in stats.columns]
    return extended.select(*[named(c) for c in df.columns], *values)
