"""Window functions along the axis that stay parallel inside a hot key.

``PARTITION BY key ORDER BY time`` puts a whole key into one task. Here a hot key is
cut into time segments (``tickshard.operators.segments``); the function runs inside
each segment and takes over from the earlier or later segments what it needs of them: one
row for a lag, a count for a row number or a rank, an aggregate for a rolling one. Other
keys go through the plain window.

Rows of one key at one instant are split further by the first *order* column, if it is
of a simple type, and freely if there is no *order* or nothing in it tells the rows apart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import micros, require_utc, width_micros
from tickshard.names import AXIS
from tickshard.operators.schema import named
from tickshard.operators.segments import (
    BEFORE_ALL,
    HOT_ROWS,
    HotKeys,
    carried,
    carried_each,
    crowded_cuts,
    default_splits,
    find_hot_keys,
    with_hot_number,
    with_segment,
)
from tickshard.plans.temporary import fixed

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType)
#: Scaled numbers beyond this count as one, so that they fit a bigint.
_FAR = 9e18


def _as_integer(df: DataFrame, order: Sequence[str]) -> tuple[Column | None, bool]:
    """A bigint that never falls where the first order column rises, and whether rows with
    one bigint are equal in that column. None for types that have no such number."""
    if not order:
        return F.lit(0).cast("bigint"), True
    kind, column, exact = df.schema[order[0]].dataType, named(order[0]), True
    if isinstance(kind, _TIMES):
        column = micros(column)
    elif isinstance(kind, T.DateType):
        column = F.unix_date(column)
    elif isinstance(kind, (T.BinaryType, T.StringType)) and _bytewise(kind):
        # the first seven bytes, as a number of fourteen hexadecimal digits
        digits = F.hex(F.substring(column.cast("binary"), 1, 7))
        column, exact = F.conv(F.rpad(digits, 14, "0"), 16, 10), False
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        # NaN is the greatest, as in an order; least and greatest would skip a NULL
        scaled = column.cast("double") * F.lit(float(1 << 20))
        within = F.greatest(F.least(scaled, F.lit(_FAR)), F.lit(-_FAR))
        column, exact = F.when(column.isNotNull(), within), False
    elif not isinstance(kind, (*_INTEGERS, T.BooleanType)):
        return None, False
    return F.coalesce(column.cast("bigint"), F.lit(BEFORE_ALL)), exact


def _bytewise(kind: T.DataType) -> bool:
    """Whether texts of this type are in the order of their bytes."""
    return not isinstance(kind, T.StringType) or kind.collation == "UTF8_BINARY"


def _rows(df: DataFrame, on: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys as ``k0..``, time as ``t``, order inside one instant as ``o`` (its first
    column as ``u``), the row as ``l``."""
    require_utc(df.sparkSession)
    if not on:
        raise ValueError("name at least one key column")
    first, _ = _as_integer(df, order)
    places = [F.lit(0).alias("o"), *[named(c).alias(f"o{i}") for i, c in enumerate(order)]]
    return df.select(
        *[named(k).alias(f"k{i}") for i, k in enumerate(on)],
        F.coalesce(micros(), F.lit(BEFORE_ALL)).alias("t"),
        *([] if first is None else [first.alias("u")]),
        F.struct(*places).alias("o"),
        F.struct(*[named(c).alias(f"c{i}") for i, c in enumerate(df.columns)]).alias("l"),
    )


def _segmented(
    df: DataFrame, on: Sequence[str], order: Sequence[str], hot_rows: int, splits: int | None
) -> tuple[DataFrame, HotKeys | None, list[str]]:
    """Rows of *df* with segments where there are hot keys, and the columns of one group."""
    rows, keys = _rows(df, on, order), [f"k{i}" for i in range(len(on))]
    splits = default_splits(rows) if splits is None else splits
    hot_keys = find_hot_keys(rows.select(*keys, "t"), keys, hot_rows, splits)
    if hot_keys is None:
        return rows, None, keys
    rows = with_hot_number(rows, hot_keys, keys)
    crowded = "u" in rows.columns and bool(hot_keys.crowded_instants())
    inner = crowded_cuts(rows, hot_keys, splits) if crowded and order else None
    # rows that could still differ in their order stay together
    spread = crowded and len(order) <= 1 and _as_integer(df, order)[1]
    placed = with_segment(rows, hot_keys, spread=spread, inner=inner)
    # Placed by task number, rows could sit elsewhere when read a second time for what
    # segments take over; so they are placed once.
    return (fixed(placed) if spread else placed), hot_keys, [*keys, "hot", "segment"]


def _unpacked(df: DataFrame, columns: list[str], *added: Column) -> DataFrame:
    return df.select(
        *[F.col("l").getField(f"c{i}").alias(c) for i, c in enumerate(columns)], *added
    )


def lagged(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    on: Sequence[str],
    order: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with, for each ``new: old`` of *columns*, the value of *old* one row earlier.

    Rows of one *on* key are ordered by ``$timestamp``, then by the *order* columns;
    these should tell rows of one instant apart. The first row of a key gets NULL.
    """
    return _shifted(df, columns, on, order, hot_rows, splits, backward=False)


def led(
    df: DataFrame,
    columns: Mapping[str, str],
    *,
    on: Sequence[str],
    order: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """The same with the value of *old* one row later; the last row of a key gets NULL."""
    return _shifted(df, columns, on, order, hot_rows, splits, backward=True)


def _shifted(df, columns, on, order, hot_rows, splits, backward: bool) -> DataFrame:
    values = F.struct(
        *[F.col("l").getField(f"c{df.columns.index(old)}").alias(f"v{i}")
          for i, old in enumerate(columns.values())]
    )
    rows, hot_keys, groups = _segmented(df, on, order, hot_rows, splits)
    rows = rows.withColumns({"v": values, "seed": F.lit(False)})
    if hot_keys is not None:
        nearest = F.min if backward else F.max
        last = (
            rows.where("hot >= 0")
            .groupBy("hot", "segment")
            .agg(nearest(F.struct("t", "o", "v")).getField("v").alias("value"))
        )
        seeds = (
            carried(last, hot_keys, lambda c: F.last(c, ignorenulls=True), backward)
            .join(F.broadcast(hot_keys.table), "hot")
            .select(
                *groups,
                F.lit(BEFORE_ALL).alias("t"),
                F.col("carried").alias("v"),
                F.lit(True).alias("seed"),
            )
        )
        rows = rows.unionByName(seeds, allowMissingColumns=True)
    # Equal rows may come in any order, but the last of a segment must be the one that
    # the next segment took over: so the value breaks ties here as it does there.
    way = F.desc if backward else F.asc
    ordered = Window.partitionBy(*groups).orderBy(F.desc("seed"), way("t"), way("o"), way("v"))
    before = rows.withColumn("p", F.lag("v").over(ordered)).where("NOT seed")
    added = [F.col("p").getField(f"v{i}").alias(new) for i, new in enumerate(columns)]
    return _unpacked(before, df.columns, *added)


def _numbered(df, on, order, hot_rows, splits, total: bool) -> DataFrame:
    """Rows with their place ``n`` in their key, from 1, and with the key's ``total``."""
    rows, hot_keys, groups = _segmented(df, on, order, hot_rows, splits)
    counts = rows
    own = Window.partitionBy(*groups)
    rows = rows.withColumn("n", F.row_number().over(own.orderBy("t", "o")).cast("bigint"))
    if total:
        rows = rows.withColumn("total", F.count("*").over(own))
    if hot_keys is not None:
        counts = counts.where("hot >= 0").groupBy("hot", "segment").agg(F.count("*").alias("value"))
        rows = _with_offset(rows, counts, hot_keys)
        if total:
            whole = F.broadcast(counts.groupBy("hot").agg(F.sum("value").alias("whole")))
            rows = rows.join(whole, "hot", "left").withColumn("total", F.coalesce("whole", "total"))
    return rows


def numbered(
    df: DataFrame,
    name: str,
    *,
    on: Sequence[str],
    order: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with the place of each row in its key, from 1, as column *name*."""
    rows = _numbered(df, on, order, hot_rows, splits, total=False)
    return _unpacked(rows, df.columns, F.col("n").alias(name))


def tiled(
    df: DataFrame,
    name: str,
    tiles: int,
    *,
    on: Sequence[str],
    order: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with, as column *name*, which of *tiles* even parts of its key a row is in, from 1.

    As SQL's ``ntile``: with a remainder the first parts have one row more.
    """
    if tiles < 1:
        raise ValueError(f"rows fall into at least one part; got {tiles}")
    rows = _numbered(df, on, order, hot_rows, splits, total=True)
    place, size, more = F.col("n") - 1, F.expr(f"total div {tiles}"), F.col("total") % tiles
    rows = rows.select("*", place.alias("p"), size.alias("size"), more.alias("more"))
    rows = rows.withColumn("ahead", F.col("more") * (F.col("size") + 1))
    first = F.expr("p div (size + 1)")
    later = F.col("more") + F.expr("(p - ahead) div greatest(size, 1)")
    tile = F.when(F.col("p") < F.col("ahead"), first).otherwise(later) + 1
    return _unpacked(rows, df.columns, tile.alias(name))


def ranked(
    df: DataFrame,
    name: str,
    *,
    on: Sequence[str],
    order: Sequence[str] = (),
    dense: bool = False,
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with the rank of each row in its key as column *name*: rows with the same time
    and *order* columns share one, and the next rank leaves out as many places as they take,
    with *dense* none.

    Rows that share a rank are first counted as one step, which moves as one row. A row's
    rank is the sum of the steps before it, so equal rows of a hot key can be in different
    tasks.
    """
    rows, hot_keys, groups, place = _placer(df, on, order, hot_rows, splits)
    keys = [f"k{i}" for i in range(len(on))]
    same = [*keys, "t", "o", *(["u"] if "u" in rows.columns else [])]
    steps = rows.groupBy(*same).agg(F.lit(1).alias("d") if dense else F.count("*").alias("d"))
    steps = place(steps.withColumn("d", F.col("d").cast("bigint")), step=True)
    asking = place(rows, step=False).withColumn("side", F.lit(0))
    every = asking.unionByName(steps.withColumn("side", F.lit(1)), allowMissingColumns=True)
    upto = Window.partitionBy(*groups).orderBy("t", "o", "side")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = every.withColumn("n", F.coalesce(F.sum("d").over(upto), F.lit(0).cast("bigint")))
    if hot_keys is not None:
        totals = steps.where("hot >= 0").groupBy("hot", "segment").agg(F.sum("d").alias("value"))
        every = _with_offset(every, totals, hot_keys)
    return _unpacked(every.where("side = 0"), df.columns, (F.col("n") + 1).alias(name))


def _placer(df, on, order, hot_rows, splits):
    """Rows of *df*, hot keys, the columns of one group, and what places rows and steps.

    Rows that are equal may be spread over the segments they share; their step is then in
    the last of these, and no row of them sees it.
    """
    rows, keys = _rows(df, on, order), [f"k{i}" for i in range(len(on))]
    splits = default_splits(rows) if splits is None else splits
    hot_keys = find_hot_keys(rows.select(*keys, "t"), keys, hot_rows, splits)
    if hot_keys is None:
        return rows, None, keys, lambda frame, step: frame
    crowded = "u" in rows.columns and bool(hot_keys.crowded_instants())
    hot = with_hot_number(rows, hot_keys, keys)
    inner = crowded_cuts(hot, hot_keys, splits) if crowded and order else None
    spread = crowded and len(order) <= 1 and _as_integer(df, order)[1]

    def place(frame: DataFrame, step: bool) -> DataFrame:
        found = with_hot_number(frame, hot_keys, keys)
        return with_segment(
            found, hot_keys, spread=spread and not step, late=spread and step, inner=inner
        )

    return rows, hot_keys, [*keys, "hot", "segment"], place


def _with_offset(rows: DataFrame, per_segment: DataFrame, hot_keys: HotKeys) -> DataFrame:
    """Add to ``n`` the sum of *per_segment* over the earlier segments of the key."""
    offsets = F.broadcast(carried(per_segment, hot_keys, F.sum))
    joined = rows.join(offsets, ["hot", "segment"], "left")
    return joined.withColumn("n", F.col("n") + F.coalesce("carried", F.lit(0))).drop("carried")


#: How the values of steps are folded.
_FOLDS = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
ROLLED = (*_FOLDS, "mean")


def rolled_within(
    df: DataFrame,
    columns: Mapping[str, tuple[str, str]],
    width: str | int | dt.timedelta,
    *,
    on: Sequence[str],
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with, for each ``new: (what, old)`` of *columns*, an aggregate of *old* over the
    rows of the key with a time in ``[t - width, t]``, the row itself included.

    *what* is sum, count, min, max or mean; NULLs of *old* are skipped, and a sum, least,
    greatest or mean of nothing is NULL. A row without a time counts for nothing and gets NULL.

    Keys without many rows go through a plain window. The time of a hot key is cut into
    blocks of *width*: a row's range is the end of one block and the beginning of the next,
    so two running aggregates answer it, one backward from the row's time less *width*, one
    forward to its time, whatever the number of rows between. Values of one instant are
    folded first. A block with many rows is cut into segments, which take over from those
    before or after them.
    """
    wide, keys = width_micros(width), [f"k{i}" for i in range(len(on))]
    for what, _ in columns.values():
        if what not in ROLLED:
            raise ValueError(f"rolled columns are one of {ROLLED}; got {what!r}")
    splits = default_splits(df) if splits is None else splits
    asked = _parts_of(columns)
    place = {old: i for i, old in enumerate(df.columns)}
    rows = _rows(df, on, ()).select(
        *keys, "t", "l", *[_step(what, place[old]).alias(v) for v, (what, old) in asked.items()]
    )
    hot_keys = find_hot_keys(rows.select(*keys, "t"), keys, hot_rows, splits)
    if hot_keys is None:
        return _answers(_plainly_rolled(rows, keys, asked, wide), df.columns, columns, asked)
    rows = with_hot_number(rows, hot_keys, keys).withColumnRenamed("hot", "h")
    hot = rows.where(f"h >= 0 AND t > {BEFORE_ALL}")
    untimed = rows.where(f"h >= 0 AND t = {BEFORE_ALL}")
    rolled = _rolled_in_blocks(hot, asked, wide, hot_rows, splits)
    every = _plainly_rolled(rows.where("h < 0"), keys, asked, wide)
    every = every.unionByName(rolled.select(every.columns)).unionByName(untimed)
    return _answers(every, df.columns, columns, asked)


def _parts_of(columns: Mapping[str, tuple[str, str]]) -> dict[str, tuple[str, str]]:
    """The aggregates to keep, by name; a mean is a sum and a count."""
    parts = {}
    for what, old in columns.values():
        for part in ("sum", "count") if what == "mean" else (what,):
            parts.setdefault((part, old), f"v{len(parts)}")
    return {name: part for part, name in parts.items()}


def _step(what: str, place: int) -> Column:
    value = F.col("l").getField(f"c{place}")
    return value.isNotNull().cast("bigint") if what == "count" else value


def _plainly_rolled(rows: DataFrame, keys: list[str], asked: dict, wide: int) -> DataFrame:
    timed = F.col("t") > BEFORE_ALL  # others, in a partition of their own, get no answer
    place = Window.partitionBy(*keys, timed).orderBy(F.when(timed, F.col("t")).otherwise(0))
    frame = place.rangeBetween(-wide, Window.currentRow)
    return rows.withColumns({v: _FOLDS[what](v).over(frame) for v, (what, _) in asked.items()})


def _rolled_in_blocks(
    rows: DataFrame, asked: dict, wide: int, hot_rows: int, splits: int
) -> DataFrame:
    """Rows of hot keys (numbered ``h``) with the aggregates of their ranges."""
    fold = [_FOLDS[what](v).alias(v) for v, (what, _) in asked.items()]
    block = F.expr(f"(t - pmod(t, {wide})) div {wide}")
    steps = rows.groupBy("h", "t").agg(*fold).withColumn("b", block)
    asking = rows.drop(*asked).withColumn("b", block)
    earlier = asking.withColumns({"at": F.col("t"), "t": F.col("t") - wide, "b": F.col("b") - 1})
    times = asking.select("h", "b", "t").unionByName(earlier.select("h", "b", "t"))
    hot_keys = find_hot_keys(times, ["h", "b"], hot_rows, splits)
    back = _run(earlier, steps, asked, hot_keys, backward=True)
    held = back.withColumnsRenamed({v: f"{v}_back" for v in asked})
    held = held.withColumns({"t": F.col("at"), "b": F.col("b") + 1}).drop("at")
    both = _run(held, steps, asked, hot_keys, backward=False)
    return both.withColumns(
        {v: _joined(what, F.col(v), F.col(f"{v}_back")) for v, (what, _) in asked.items()}
    )


def _joined(what: str, a: Column, b: Column) -> Column:
    if what in ("min", "max"):
        return (F.least if what == "min" else F.greatest)(a, b)
    return F.coalesce(a + b, a, b)


def _run(
    asking: DataFrame, steps: DataFrame, asked: dict, hot_keys: HotKeys | None, backward: bool
) -> DataFrame:
    """*asking* with, for each of *asked*, the fold of the *steps* of its block up to its
    time, with *backward* of those from its time on."""
    keys, groups = ["h", "b"], ["h", "b"]
    folds = {v: _FOLDS[what] for v, (what, _) in asked.items()}
    if hot_keys is not None:
        groups += ["hot", "segment"]
        asking = with_segment(with_hot_number(asking, hot_keys, keys), hot_keys, spread=True)
        steps = with_segment(with_hot_number(steps, hot_keys, keys), hot_keys, spread=False, late=backward)
    every = asking.withColumn("side", F.lit(1)).unionByName(
        steps.withColumn("side", F.lit(0)), allowMissingColumns=True
    )
    time = F.desc("t") if backward else F.asc("t")
    upto = Window.partitionBy(*groups).orderBy(time, "side")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = every.withColumns({v: fold(v).over(upto) for v, fold in folds.items()})
    every = every.where("side = 1").drop("side")
    if hot_keys is None:
        return every
    own = steps.where("hot >= 0").groupBy("hot", "segment")
    own = own.agg(*[fold(v).alias(v) for v, fold in folds.items()])
    over = carried_each(own, hot_keys, folds, backward)
    over = F.broadcast(over.withColumnsRenamed({v: f"{v}_over" for v in asked}))
    joined = every.join(over, ["hot", "segment"], "left").withColumns(
        {v: _joined(what, F.col(v), F.col(f"{v}_over")) for v, (what, _) in asked.items()}
    )
    return joined.drop("hot", "segment", *[f"{v}_over" for v in asked])


def _answers(rows: DataFrame, names: list[str], columns: Mapping, asked: dict) -> DataFrame:
    timed = F.col("t") > BEFORE_ALL
    part = {part: F.col(name) for name, part in asked.items()}

    def answer(what: str, old: str) -> Column:
        if what == "mean":
            return F.try_divide(part["sum", old], part["count", old])
        return F.coalesce(part["count", old], F.lit(0)) if what == "count" else part[what, old]

    added = [F.when(timed, answer(*asked_for)).alias(new) for new, asked_for in columns.items()]
    return _unpacked(rows, names, *added)


def counted_within(
    df: DataFrame,
    name: str,
    width: str | int | dt.timedelta,
    *,
    on: Sequence[str],
    hot_rows: int = HOT_ROWS,
    splits: int | None = None,
) -> DataFrame:
    """*df* with, as column *name*, how many rows of its key have a time in
    ``[t - width, t]``, the row itself included. A row without a time counts for
    nothing and gets NULL. See ``rolled_within``.
    """
    return rolled_within(
        df, {name: ("count", AXIS)}, width, on=on, hot_rows=hot_rows, splits=splits
    )
