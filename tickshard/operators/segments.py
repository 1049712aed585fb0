"""Cutting hot keys into time segments, so that no task gets a whole hot key.

A key is hot when it has more rows than a limit of at least ``total / splits``, so
there can be at most ``splits`` hot keys: what is collected and broadcast here (hot
keys and their cut points, about ``2 * splits`` of them) is bounded by a setting and
not by the data. Cut points are quantiles of the key's times. Where one instant holds
several quantiles, its rows may go to any of the segments between them, which splits
even a key whose rows all have the same time.

Hot keys and cut points come from a sample, as those of a range partitioning do. The
sample only decides where to cut: every row is placed, and a key that is missed or cut
unevenly gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows a key may have before it is looked at as hot at all.
HOT_ROWS = 5_000_000

# Sampled rows that stand for one segment; a limit below it is looked at in full.
SAMPLED_ROWS = 200

BEFORE_ALL = -(2**63)  # an instant before every other


@dataclass
class HotKeys:
    """Hot keys, numbered, and their sorted cut points in microseconds."""

    table: DataFrame | None  # key columns and "hot" (the number); None: one key for all rows
    cuts: dict[int, np.ndarray]
    share: float  # of the rows that were sampled

    def segment_count(self, hot: int) -> int:
        return len(self.cuts[hot]) + 1

    def crowded_instants(self) -> list[tuple[int, int, int]]:
        """(hot key number, instant, cut points) where an instant holds several."""
        return [
            (hot, int(instant), int(count))
            for hot, cuts in self.cuts.items()
            for instant, count in zip(*np.unique(cuts, return_counts=True))
            if count > 1
        ]


def default_splits(df: DataFrame) -> int:
    """Twice the shuffle partitions, so that segments spread evenly over them."""
    return max(1_000, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _quantiles(splits: int, column: str = "t") -> Column:
    grid = F.lit([i / splits for i in range(1, splits + 1)])
    return F.percentile_approx(column, grid, F.lit(max(1_000, 20 * splits)))


def _cuts(quantiles: Column, parts: Column, splits: int) -> Column:
    """Every ``splits / parts``-th quantile: ``parts - 1`` cut points."""
    return F.transform(
        F.sequence(F.lit(1), (parts - 1).cast("int")),
        lambda i: F.element_at(quantiles, F.floor(i * splits / parts).cast("int")),
    )


def _sample(rows: DataFrame, share: float) -> DataFrame:
    return rows if share >= 1 else rows.sample(share, seed=1)


def find_hot_keys(
    times: DataFrame, keys: Sequence[str], hot_rows: int, splits: int
) -> HotKeys | None:
    """Hot keys of *times*, a frame of the key columns and a bigint ``t``; without key
    columns all rows are one key.

    Takes a row count, one count per key of a sample when the frame is large enough to
    have a hot key at all, and quantiles for the hot ones only.
    """
    total = times.count()
    limit = max(hot_rows, -(-total // splits))
    if total <= limit:
        return None
    share = min(1.0, SAMPLED_ROWS / limit)
    sample = _sample(times, share)
    hot = sample.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > limit * share)
    counts = hot.collect()  # fewer than *splits* keys can have so many rows
    if not counts:
        return None
    if keys:
        few = times.sparkSession.createDataFrame(counts, hot.schema)
        sample = sample.join(F.broadcast(few.drop("n")), same_keys(sample, few, keys), "left_semi")
    counted = sample.groupBy(*keys).agg(F.count("*").alias("n"), _quantiles(splits).alias("q"))
    parts = F.least(F.ceil(F.col("n") / (limit * share)), F.lit(splits)).cast("int")
    found = counted.select(*keys, _cuts(F.col("q"), parts, splits).alias("cuts")).collect()
    cuts = {number: np.array(row["cuts"], dtype="int64") for number, row in enumerate(found)}
    if not keys:
        return HotKeys(None, cuts, share)
    schema = T.StructType([*(times.schema[k] for k in keys), T.StructField("hot", T.IntegerType())])
    numbered = [(*(row[k] for k in keys), number) for number, row in enumerate(found)]
    return HotKeys(times.sparkSession.createDataFrame(numbered, schema), cuts, share)


def crowded_cuts(rows: DataFrame, hot_keys: HotKeys, splits: int) -> dict[int, dict]:
    """Cut points inside crowded instants, by the column ``u`` of *rows* (with ``hot``).

    An instant with *m* cut points is shared by *m* segments and gets ``m - 1`` inner
    ones, so there are no more of these than of the others.
    """
    crowded = hot_keys.crowded_instants()
    inner: dict[int, dict] = {}
    if crowded:
        table = rows.sparkSession.createDataFrame(crowded, "hot int, t bigint, parts int")
        quantiles = (
            _sample(rows.select("hot", "t", "u"), hot_keys.share)
            .join(F.broadcast(table), ["hot", "t"])
            .groupBy("hot", "t", "parts")
            .agg(_quantiles(splits, "u").alias("q"))
        )
        cuts = _cuts(F.col("q"), F.col("parts"), splits).alias("cuts")
        for row in quantiles.select("hot", "t", cuts).collect():
            inner.setdefault(row["hot"], {})[row["t"]] = np.array(row["cuts"], dtype="int64")
    return inner


def with_hot_number(rows: DataFrame, hot_keys: HotKeys, keys: Sequence[str]) -> DataFrame:
    """*rows* with ``hot``: the number of its hot key, -1 for other keys."""
    table = hot_keys.table
    if table is None:
        return rows.withColumn("hot", F.lit(0))
    return rows.join(F.broadcast(table), same_keys(rows, table, keys), "left").select(
        *[rows[c] for c in rows.columns], F.coalesce("hot", F.lit(-1)).alias("hot")
    )


def with_segment(
    numbered: DataFrame,
    hot_keys: HotKeys,
    *,
    spread: bool,
    late: bool = False,
    inner: dict[int, dict] | None = None,
) -> DataFrame:
    """Rows (with ``hot`` and ``t``, and ``u`` where *inner* is given) with ``segment``.

    A row between cut points goes to the segment between them. A row on an instant
    with cut points goes to the first segment after the times below it, with *late* to the
    last one that the instant shares. With *inner*
    cut points, rows of a crowded instant go to its segments in the order of ``u``.
    With *spread*, rows that are equal so far may go to any segment that is left to
    them; the spread goes by the number of the task, which is the same when a lost
    task runs again.
    """
    cuts, inner = hot_keys.cuts, inner or {}

    def place(bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many cut points lie below each value, and how many on it."""
        below = np.searchsorted(bounds, values, side="left")
        return below, np.searchsorted(bounds, values, side="right") - below

    @F.pandas_udf("int")
    def locate(hot: pd.Series, t: pd.Series, u: pd.Series, task: pd.Series) -> pd.Series:
        numbers, instants, orders, tasks = (x.to_numpy() for x in (hot, t, u, task))
        segment = np.zeros(len(numbers), dtype="int32")
        for number in np.unique(numbers[numbers >= 0]):
            mine = np.flatnonzero(numbers == number)
            below, on = place(cuts[number], instants[mine])
            most = np.maximum(on, 1)
            step = tasks[mine] % most if spread else most - 1 if late else 0
            segment[mine] = below + np.where(on > 0, step + 1, 0)
            for instant, bounds in inner.get(number, {}).items():
                here = instants[mine] == instant
                rows = mine[here]
                inner_below, inner_on = place(bounds, orders[rows])
                step = tasks[rows] % (inner_on + 1) if spread else inner_on if late else 0
                segment[rows] = below[here] + 1 + inner_below + step
        return pd.Series(segment)

    order = F.col("u") if inner else F.lit(0).cast("bigint")
    task = F.spark_partition_id() if spread else F.lit(0)
    # Marked non-deterministic so that no inferred filter evaluates it a second time.
    return numbered.withColumn("segment", locate.asNondeterministic()("hot", "t", order, task))


def carried(
    per_segment: DataFrame,
    hot_keys: HotKeys,
    combine: Callable[[str], Column],
    backward: bool = False,
) -> DataFrame:
    """What each segment of a hot key takes over from the segments before it, with
    *backward* from those after it.

    *per_segment* has ``hot``, ``segment`` and ``value``, one row for each segment that
    has rows; *combine* folds the values of earlier segments. The result has a row for
    every segment with something to take over, as ``carried``. This runs over one row
    per segment, of which there are at most ``2 * splits``.
    """
    folded = carried_each(per_segment, hot_keys, {"value": combine}, backward)
    folded = folded.withColumnRenamed("value", "carried")
    return folded.where("carried IS NOT NULL").select("hot", "segment", "carried")


def carried_each(
    per_segment: DataFrame,
    hot_keys: HotKeys,
    combine: Mapping[str, Callable[[str], Column]],
    backward: bool = False,
) -> DataFrame:
    """The same for several columns of *per_segment*, each under its own name, with a row for
    every segment."""
    cells = per_segment.sparkSession.createDataFrame(
        [(h, s) for h in hot_keys.cuts for s in range(hot_keys.segment_count(h))],
        "hot int, segment int",
    )
    order = F.desc("segment") if backward else F.asc("segment")
    earlier = Window.partitionBy("hot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    held = cells.join(per_segment, ["hot", "segment"], "left")
    return held.withColumns({name: fold(name).over(earlier) for name, fold in combine.items()})
