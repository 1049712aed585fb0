"""Statistics stored with shards: count, sum and squared deviations of each write's rows.

A measured table keeps, for each generation, one small Parquet folder beside its rows with
one row for each shard and measured column. Statistics of the table, or of a range of time,
come from these rows: sums add up, and deviations from a shard's own mean are moved to the
mean of all, so nothing large is subtracted from something large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.missing import nan_to_null
from tickshard.names import GEN, SHARD
from tickshard.operators.schema import named

FOLDER = "_moments"  # hidden from Spark's listings
WHOLE = "decimal(38,0)"


def folder(root: str, gen: int | None = None) -> str:
    return f"{root}/{FOLDER}" if gen is None else f"{root}/{FOLDER}/{GEN}={gen}"


def is_whole(schema: T.StructType, column: str) -> bool:
    return isinstance(schema[column].dataType, T.IntegralType)


def _of_column(column: str, whole: bool) -> Column:
    """(name, n, whole, part, spread) of one column's values; sums of integers are exact."""
    value = named(column)
    total = F.sum(value.cast(WHOLE)) if whole else F.lit(None).cast(WHOLE)
    part = F.lit(None).cast("double") if whole else F.sum(value.cast("double"))
    return F.struct(
        F.lit(column).alias("column"),
        F.count(value).alias("n"),
        total.alias("whole"),
        part.alias("part"),
        (F.var_pop(value) * F.count(value)).alias("spread"),
    )


def built(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(shard, column, n, whole, part, spread) for rows with their ``$shard``: one pass over
    the measured columns, aggregated before it moves."""
    values = nan_to_null(rows.select(F.col(SHARD).alias("shard"), *[named(c) for c in columns]), *columns)
    each = [_of_column(c, is_whole(rows.schema, c)) for c in columns]
    return values.groupBy("shard").agg(F.array(*each).alias("each")).select("shard", F.inline("each"))


def merged(moments: DataFrame, columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """One row with ``sum_c``, ``mean_c`` and ``std_c`` for each column, as
    ``tickshard.global_stats`` gives them for the rows the *moments* were made of."""
    filled = moments.where(F.col("n") > 0)
    total = F.coalesce(F.col("part"), F.col("whole").cast("double"))
    own = total / F.col("n")
    # The mean of all: a few numbers, one for each column.
    means = filled.groupBy("column").agg((F.sum(total) / F.sum("n")).alias("mean"))
    placed = filled.join(F.broadcast(means), "column")
    away = F.col("spread") + F.col("n") * (own - F.col("mean")) * (own - F.col("mean"))
    measures = []
    for column in columns:
        mine = lambda value, name=column: F.when(F.col("column") == name, value)
        whole = is_whole(schema, column)
        added = F.sum(mine(F.col("whole" if whole else "part")))
        nothing = F.lit(0).cast(WHOLE) if whole else F.lit(0.0)
        n, spread = F.sum(mine(F.col("n"))), F.sum(mine(away))
        measures += [
            F.coalesce(added.cast(WHOLE) if whole else added, nothing).alias(f"sum_{column}"),
            F.max(mine(F.col("mean"))).alias(f"mean_{column}"),
            F.when(n > 1, F.sqrt(spread / (n - 1))).alias(f"std_{column}"),
        ]
    return placed.agg(*measures)


def not_numbers(schema: T.StructType, columns: Sequence[str]) -> list[str]:
    """Those of *columns* that are not columns of numbers."""
    numbers = {f.name for f in schema if isinstance(f.dataType, T.NumericType)}
    return [c for c in columns if c not in numbers]
