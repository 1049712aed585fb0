"""How a batch meets stored rows: append, truncate a time range, drop or replace repeats.

What a write leaves shows up in one step, see ``tickshard.plans.snapshots``.

Every function takes rows that are already typed and carry ``$shard``. Except for
the plain append, the batch is staged first: it is then evaluated once, a batch
that fails leaves the table as it was, and the passes below read only the columns
they need. Running the same truncate or deduplicated write again changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickshard.functions.clock import instant_micros
from tickshard.names import AXIS, SHARD, quoted_column
from tickshard.operators.axis import within
from tickshard.operators.schema import named
from tickshard.plans.snapshots import Stored, runs_of
from tickshard.plans.tables import in_shards
from tickshard.plans.temporary import staged


def append_staged(table: str, rows: DataFrame) -> None:
    with staged(rows) as batch:
        Stored(rows.sparkSession, table).append(batch)


def _outline(batch: DataFrame) -> dict[int, tuple[int, int]]:
    """First and last instant of a staged batch in each of its shards, in microseconds;
    one row per shard, aggregated before it moves."""
    rows = batch.groupBy(SHARD).agg(F.min(AXIS), F.max(AXIS)).collect()
    return {shard: (instant_micros(lo), instant_micros(hi)) for shard, lo, hi in rows}


def _span(outline: dict[int, tuple[int, int]]) -> list[tuple[int, int]]:
    """The closed range of a batch as a half-open one."""
    return [(outline[min(outline)][0], outline[max(outline)][1] + 1)] if outline else []


def truncate_range(table: str, rows: DataFrame) -> None:
    """Replace everything between the batch's first and last instant (both included).

    Only the two outermost shards can keep old rows, so no other old row is read.
    An empty batch replaces nothing.
    """
    with staged(rows) as batch:
        outline = _outline(batch)
        if not outline:
            return
        first, last = min(outline), max(outline)
        stored = Stored(rows.sparkSession, table)
        kept = stored.rows().where(F.col(SHARD).isin(first, last) & ~within(_span(outline)))
        stored.replace(batch.unionByName(kept, allowMissingColumns=True), [[first, last]])


def _match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys; stays a hash or sort-merge join."""
    pairs = [left[quoted_column(k)].eqNullSafe(right[quoted_column(k)]) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Collapse repeats inside a batch: for one key the row last by the other columns
    (the time first) stays. Partial aggregation thins a hot key before the shuffle."""
    others = [c for c in rows.columns if c not in keys and c != SHARD]
    if not others:
        return rows.distinct()
    others.sort(key=lambda c: c != AXIS)
    last = F.max(F.struct(*[named(c) for c in others], named(SHARD))).alias("last")
    picked = rows.groupBy(*[named(k) for k in keys]).agg(last)
    columns = [named(c) if c in keys else F.col("last").getField(c).alias(c) for c in rows.columns]
    return picked.select(columns)


def _candidates(
    table: Stored, batch: DataFrame, keys: list[str], outline: dict[int, tuple[int, int]]
) -> DataFrame:
    """Stored rows that could repeat a key: when the time is part of the key, those in the
    batch's shards and time range; else those in the shards an index allows, or all."""
    stored = table.rows()
    if AXIS not in keys:
        shards = table.shards_with(batch, keys)
        return stored if shards is None else stored.where(in_shards(shards))
    return stored.where(in_shards(outline) & within(_span(outline)))


def append_new(table: str, rows: DataFrame, keys: list[str]) -> None:
    """Append the batch's rows whose key is not stored yet.

    The stored side is reduced to the keys the batch repeats before anything else,
    by a semi join in which a small batch is broadcast by adaptive execution, so a
    big table is then only scanned. Copies of one stored key fold into one row.
    """
    with staged(one_per_key(rows, keys)) as batch:
        outline = _outline(batch) if AXIS in keys else {}
        table = Stored(rows.sparkSession, table)
        stored = _candidates(table, batch, keys, outline).select([named(k) for k in keys])
        wanted = batch.select([named(k) for k in keys])
        repeated = stored.join(wanted, _match(stored, wanted, keys), "left_semi").distinct()
        fresh = batch.join(repeated, _match(batch, repeated, keys), "left_anti")
        table.append(fresh, alone=True)


def replace_matching(table: str, rows: DataFrame, keys: list[str]) -> None:
    """Replace stored rows that share a key with the batch, and add the rest.

    One semi join over the key columns finds the shards with a match. Only these are
    rewritten; the batch's rows for other shards are added in the same step. A shard that
    loses all rows and gets none is gone.
    """
    with staged(one_per_key(rows, keys)) as batch:
        outline = _outline(batch)
        table = Stored(rows.sparkSession, table)
        wanted = batch.select(*[named(k) for k in keys])
        probe = _candidates(table, batch, keys, outline)
        probe = probe.select(*[named(k) for k in keys], SHARD)
        matches = probe.join(wanted, _match(probe, wanted, keys), "left_semi")
        touched = [r[SHARD] for r in matches.select(SHARD).distinct().collect()]
        stored = table.rows().where(in_shards(touched))
        keyed = batch.select([named(k) for k in keys])
        kept = stored.join(keyed, _match(stored, keyed, keys), "left_anti")
        renewed = batch.unionByName(kept, allowMissingColumns=True) if touched else batch
        table.replace(renewed, runs_of(touched))
