"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions.

1. Every source gets a target of words: its weight's share of all words, at most ``REPEATS``
   times its own; what a source cannot take goes to the others by weight.
2. The documents of a source lie one after the other in the order of a digest, so each has
   an offset in words. Its words are taken from the start, in as many rounds as the target
   needs, and the last document taken is cut at the target.
3. A source's schedule says how its rate changes over the time 0 to 1 of the training. The
   integral of the rate is its cumulative demand; the time at which demand reaches a
   document's offset is found by inverting the integral, and all sources' demand up to that
   time is the document's position, in words from the start of the training.
4. Documents are sorted by position with a range partitioning.

Offsets come from sums over cells, ranges of the digest, so no task sees a whole source.
Rows that are alike in id, source and text are one row with a count until the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, result

#: Weights of sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken at most so many times.
REPEATS = 3
#: Rates at times from 0 to 1, linear in between, for sources in order, repeating: the first
#: fades, the second is even, the third comes up. Only their shape counts.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 0.75), (1.0, 2.25)),
)
#: Different rows of a cell, on average.
CELL = 20_000
#: Cells of a source at most.
MOST_CELLS = 1 << 22
#: Rows that one element of an unfolded count makes.
UNFOLD = 4096

Schedule = Sequence[tuple[float, float]]
_NAMES = set("doc_id source size digest alike cell own s c before source_size target kind "
             "offset stretch turn copies taken copy words position".split())


class Demand:
    """The integral of a schedule, scaled to 1 at time 1, and its inverse."""

    def __init__(self, schedule: Schedule):
        times = [t for t, _ in schedule]
        if times != sorted(set(times)) or times[0] != 0 or times[-1] != 1:
            raise ValueError("a schedule runs from time 0 to time 1")
        if any(rate < 0 for _, rate in schedule):
            raise ValueError("rates are not negative")
        pieces, total = [], 0.0
        for (t, r), (t_end, r_end) in zip(schedule, schedule[1:]):
            pieces.append((t, r, (r_end - r) / (t_end - t), total))
            total += (t_end - t) * (r + r_end) / 2
        if not total > 0:
            raise ValueError("a schedule needs a rate above 0")
        #: Time, rate, slope and demand at the start of each piece.
        self.pieces = [(t, r / total, s / total, d / total) for t, r, s, d in pieces]

    def at(self, time: Column) -> Column:
        """The share of demand up to *time*."""
        return self._choose(
            time, 0, lambda t, r, s, d: F.lit(d) + (F.lit(r) + F.lit(s / 2) * (time - t)) * (time - t)
        )

    def time(self, share: Column) -> Column:
        """The time at which demand reaches *share*."""

        def inverse(t, r, s, d):
            more = share - F.lit(d)
            root = F.sqrt(F.greatest(F.lit(r * r) + more * F.lit(2 * s), F.lit(0.0)))
            step = F.coalesce(F.try_divide(more * 2, F.lit(r) + root), F.lit(1.0))
            return F.when(more <= 0, F.lit(t)).otherwise(F.least(F.lit(t) + step, F.lit(1.0)))

        return self._choose(share, 3, inverse)

    def _choose(self, value: Column, key: int, formula) -> Column:
        chosen = formula(*self.pieces[0])
        for piece in self.pieces[1:]:
            chosen = F.when(value >= F.lit(piece[key]), formula(*piece)).otherwise(chosen)
        return chosen


def _numbered_sources(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(source, source_size, number): sources by code point from 0, NULL last.

    Each range of names is numbered by itself and follows the names of those before it.
    """
    ranged = sizes.repartitionByRange(F.asc_nulls_last("source"))
    ranged = scratch.store(ranged.withColumn("cell", F.spark_partition_id()))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition
    offsets = ranged.groupBy("cell").count()
    offsets = offsets.select("cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("cell").orderBy(F.asc_nulls_last("source")))
    numbered = ranged.withColumn("own", own - 1).join(offsets, "cell")
    return numbered.select("source", "source_size", (F.col("first") + F.col("own")).alias("number"))


def _repeating(values: Sequence, number: str) -> Column:
    place = F.pmod(F.col(number), F.lit(len(values))).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), place)


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """*sources* (source_size, weight) with the target of each.

    Sources share all words by weight; one that would get more than *repeats* times its size
    gets that, and the rest is shared anew until none is above. Each turn asks for one row.
    """
    most = F.col("source_size") * repeats
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    full, left, weights = 0, total, None
    wide = lambda c: c.cast("decimal(19,0)")
    while True:
        # full sources are those whose limit is at most weight * left / weights
        above = F.lit(False)
        if weights is not None:
            above = wide(most) * wide(F.lit(weights)) <= wide(F.col("weight")) * wide(F.lit(left))
        taken, open_weights, n = sources.agg(
            F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
            F.count(F.when(above, 1)),
        ).first()
        if weights is not None and n == full:
            break
        full, left, weights = n, total - taken, open_weights
        if not weights:
            return sources.withColumn("target", most.cast("double"))
    # a literal is an int or a bigint by its value, so a plain product would overflow
    share = (F.col("weight") * wide(F.lit(left))).cast("double") / F.lit(float(weights))
    return sources.withColumn("target", F.when(above, most.cast("double")).otherwise(share))


def _units(docs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row for all rows that are alike in id, source and text, with their number."""
    words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    digest = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text"), 256)
    if taken_names := _NAMES & set(carried):
        raise ValueError(f"names of the result can't be carried: {sorted(taken_names)}")
    keyed = docs.select(*dict.fromkeys(["doc_id", "text", "source", *carried])).withColumns(
        {"size": F.coalesce(words, F.lit(0)).cast("bigint"), "digest": digest}
    )
    some = [F.any_value(c).alias(c) for c in carried]
    return keyed.groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("alike"), *some)


def _cell(ways: int) -> Column:
    """The place of a digest among *ways* equal ranges."""
    lead = F.conv(F.substring("digest", 1, 10), 16, 10).cast("bigint")
    return F.shiftright(lead * F.lit(ways).cast("bigint"), 40).cast("int")


def assign(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    carried: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) and *carried* for every row of *docs*.

    ``copies`` lists (position, words) of each time the document is taken; ``taken`` is
    their sum. *docs*: doc_id, text, source. A size is the number of runs without ASCII
    white space, 0 for a NULL text. Sources are ordered by code point, NULL last. Rows
    without words and all rows of a corpus without words have no copies. Rows that are alike
    in id, source and text are taken one after the other, so which of them is taken more often does not show;
    of other columns they carry any row's. The result is lazy: it reads *docs* when it is read, and small
    tables that expire in a day; an empty table has no rows.
    """
    demands = [Demand(s) for s in schedules]
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        units = scratch.store(_units(docs))
        ways = max(1, min(MOST_CELLS, -(-units.count() // CELL)))
        cells = scratch.store(
            units.withColumn("cell", _cell(ways))
            .groupBy("source", "cell")
            .agg(F.sum(F.col("size") * F.col("alike")).alias("words"))
        )
        sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
        sources = _numbered_sources(sizes, scratch)
        sources = sources.withColumn("weight", _repeating(weights, "number"))
        sources = scratch.store(targets(scratch.store(sources)))
        kind = F.pmod(F.col("number"), F.lit(len(demands))).cast("int").alias("kind")
        by_kind = dict(sources.groupBy(kind).agg(F.sum(F.col("target").cast("decimal(38,6)"))).collect())
        before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        offsets = cells.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        named = sources.select(F.col("source").alias("s"), "source_size", "target", kind)
        plan = result(
            offsets.join(named, F.col("source").eqNullSafe(F.col("s")))
            .select(F.col("source").alias("s"), F.col("cell").alias("c"), "before", "source_size", "target", "kind")
        )
    inside = Window.partitionBy("source", "cell").orderBy("digest", "doc_id")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = _units(docs, carried).withColumn("cell", _cell(ways))
    placed = placed.withColumn("own", F.coalesce(F.sum(F.col("size") * F.col("alike")).over(earlier), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))
    placed = placed.join(plan, same).withColumn("offset", F.col("before") + F.col("own"))
    return _with_copies(_unfolded(placed), demands, by_kind).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "copies", *carried
    )


def _unfolded(placed: DataFrame) -> DataFrame:
    """A row for each of the rows that were alike, each with its own offset."""
    stretch = F.explode(F.sequence(F.lit(0), F.expr(f"(alike - 1) div {UNFOLD}"))).alias("stretch")
    rows = placed.select("*", stretch)
    low = F.col("stretch") * UNFOLD
    turn = F.explode(F.sequence(low, F.least(low + UNFOLD, F.col("alike")) - 1)).alias("turn")
    return rows.select("*", turn).withColumn("offset", F.col("offset") + F.col("turn") * F.col("size"))


def _with_copies(rows: DataFrame, demands: Sequence[Demand], by_kind: dict) -> DataFrame:
    """*rows* (offset, size, source_size, target, kind) with their copies."""

    def copy(turn: Column) -> Column:
        begin = F.col("offset") + turn * F.col("source_size")
        words = F.least(F.col("size"), F.floor(F.col("target")).cast("bigint") - begin)
        share = F.try_divide(begin.cast("double"), F.col("target"))
        return F.struct(share.alias("share"), words.alias("words"))

    def timed(copy: Column) -> Column:
        time = demands[0].time(copy["share"])
        for number, demand in enumerate(demands[1:], 1):
            time = F.when(F.col("kind") == number, demand.time(copy["share"])).otherwise(time)
        return F.struct(time.alias("time"), copy["words"].alias("words"))

    def at_position(copy: Column) -> Column:
        parts = [d.at(copy["time"]) * F.lit(float(by_kind.get(n) or 0)) for n, d in enumerate(demands)]
        return F.struct(sum(parts[1:], parts[0]).alias("position"), copy["words"].alias("words"))

    turns = F.sequence(F.lit(0).cast("bigint"), F.lit(REPEATS - 1).cast("bigint"))
    made = F.filter(F.transform(turns, copy), lambda c: c["words"] > 0)
    copies = F.transform(F.transform(made, timed), at_position)
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda total, c: total + c["words"])
    return rows.withColumn("copies", copies).withColumn("taken", taken)


def in_order(assigned: DataFrame) -> DataFrame:
    """What ``assign`` returns, sorted by the first position and the id; rows that are not
    taken come last. Ranges are cut by the id, too, since those have no position."""
    order = [F.asc_nulls_last(F.get("copies", F.lit(0))["position"]), F.asc_nulls_last("doc_id")]
    return assigned.repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, carried: Sequence[str] = ("text",), **options) -> DataFrame:
    """The training order: a row for each copy, sorted by position.

    doc_id, source, words (the first so many are taken), position, and *carried* columns.
    Partitions are ranges of positions in order, sorted inside. See ``assign``.
    """
    copies = assign(docs, carried=carried, **options)
    rows = copies.select("doc_id", "source", F.explode("copies").alias("copy"), *carried)
    rows = rows.select("doc_id", "source", "copy.words", "copy.position", *carried)
    return rows.repartitionByRange("position").sortWithinPartitions("position", "doc_id")
