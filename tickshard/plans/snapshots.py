"""Tables whose writes show up at once: generations of rows, versions, and a view.

A table ``t`` is a view over the Parquet table ``t__rows``, which is partitioned by
``$gen`` and ``$shard``. Every write puts its rows into a generation of its own, which no
reader sees yet, and ends with one new version: a small file that only one writer can
create. A version says

- which generations may be seen: those up to ``last`` that are not ``open``,
- which shards of older generations a write has replaced (``dead``),
- the last batch of each stream.

The view is then replaced, in one catalog statement, by one with the predicate of the new
version. The predicate reads partition columns only, so it prunes partitions. A frame that
was made before keeps the predicate it was made with, and what it reads stays for the time
in ``GRACE``; after that the next write removes it. A writer that dies leaves a generation
that is never seen. A writer that replaces rows and finds that others were written since it
read fails with ``ConcurrentWriteError``; appends go on after each other.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import instant_micros, width_micros
from tickshard.names import AXIS, GEN, SHARD, quoted_column
from tickshard.operators.axis import any_of, merged_ranges, within
from tickshard.plans import files, keyindex, moments
from tickshard.plans.tables import (
    PARTITIONS_PER_STATEMENT,
    WIDTH_PROPERTY,
    clustered,
    in_table_order,
    location,
    plain_shards,
    properties,
    quoted,
)

#: Setting: how long replaced rows stay for readers that began before.
GRACE, DEFAULT_GRACE = "tickshard.grace", "1h"
#: Setting: after this time a generation without an end counts as given up.
LEASE, DEFAULT_LEASE = "tickshard.lease", "1d"
FOLDER_PROPERTY = "tickshard.folder"
VERSIONS = "_versions"  # hidden from Spark's listings
KEPT_VERSIONS = 20

Runs = list[list[int]]


class ConcurrentWriteError(RuntimeError):
    """Another write changed the table; nothing of this one can be seen. Run it again."""


@dataclass(frozen=True)
class Version:
    """What a table holds; *changes* counts the versions that changed its rows."""

    number: int = 0
    changes: int = 0
    last: int = 0
    following: int = 1
    #: Generations without an end, and when they began.
    open: dict[int, int] | None = None
    #: Generations whose lease ended; their writer may still be there.
    lost: tuple[int, ...] = ()
    #: Runs of shards, the first generation that still counts there, and since when.
    dead: tuple[tuple[Runs, int, int], ...] = ()
    #: The last batch of each stream.
    batches: dict[str, int] | None = None
    #: Key columns that generations have an index of.
    indexed: tuple[str, ...] = ()
    #: Columns whose moments generations keep.
    measured: tuple[str, ...] = ()

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def of(text: str) -> Version:
        held = json.loads(text)
        held["open"] = {int(k): v for k, v in (held["open"] or {}).items()}
        held["batches"] = held["batches"] or {}
        held["lost"], held["dead"] = tuple(held["lost"]), tuple(map(tuple, held["dead"]))
        held["indexed"], held["measured"] = tuple(held["indexed"]), tuple(held.get("measured", ()))
        return Version(**held)

    def hidden(self) -> list[int]:
        """Generations up to the last one that are not to be seen."""
        return sorted(g for g in {*(self.open or ()), *self.lost} if g <= self.last)

    def sees(self, gen: int, shard: int) -> bool:
        covered = lambda runs: any(a <= shard <= b for a, b in runs)
        return (
            gen <= self.last
            and gen not in self.hidden()
            and not any(gen < below and covered(runs) for runs, below, _ in self.dead)
        )

    def predicate(self) -> str:
        gen, shard = quoted_column(GEN), quoted_column(SHARD)
        parts = [f"{gen} <= {self.last}"]
        if hidden := self.hidden():
            parts.append(f"{gen} NOT IN ({', '.join(map(str, hidden))})")
        for runs, below, _ in self.dead:
            single = [str(a) for a, b in runs if a == b]
            within = [f"{shard} BETWEEN {a} AND {b}" for a, b in runs if a < b]
            within += [f"{shard} IN ({', '.join(single)})"] if single else []
            parts.append(f"NOT ({gen} < {below} AND ({' OR '.join(within)}))")
        return " AND ".join(parts)


def runs_of(shards: Iterable[int]) -> Runs:
    runs: Runs = []
    for shard in sorted(set(shards)):
        if runs and shard == runs[-1][1] + 1:
            runs[-1][1] = shard
        else:
            runs.append([shard, shard])
    return runs


def _micros() -> int:
    return instant_micros(dt.datetime.now(dt.timezone.utc))


def rows_table(table: str) -> str:
    head, _, last = table.rpartition(".")
    last = last.strip("`") + "__rows"
    return f"{head}.`{last}`" if head else f"`{last}`"


def _folder(spark: SparkSession, table: str) -> str | None:
    return properties(spark, table).get(FOLDER_PROPERTY)


def is_versioned(spark: SparkSession, table: str) -> bool:
    return _folder(spark, table) is not None


def _version_file(folder: str, number: int) -> str:
    return f"{folder}/{VERSIONS}/{number:020d}.json"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = files.names_in(spark, f"{folder}/{VERSIONS}")
    return sorted(int(n[:20]) for n in names if n[:20].isdigit() and n.endswith(".json"))


def _latest(spark: SparkSession, folder: str) -> Version | None:
    numbers = _numbers(spark, folder)
    return Version.of(files.read_text(spark, _version_file(folder, numbers[-1]))) if numbers else None


def _changed(spark: SparkSession, folder: str, change) -> Version:
    """The next version, made by *change* from the latest one, whatever others do."""
    while True:
        version = change(_latest(spark, folder))
        if files.create_new(spark, _version_file(folder, version.number), version.text()):
            if version.number >= KEPT_VERSIONS:
                files.remove(spark, _version_file(folder, version.number - KEPT_VERSIONS))
            return version


def create(
    spark: SparkSession, table: str, schema: T.StructType, width: int, path: str | None = None
) -> None:
    columns = [T.StructField(f.name, f.dataType) for f in schema]
    columns += [T.StructField(GEN, T.LongType()), T.StructField(SHARD, T.LongType())]
    statement = (
        f"CREATE TABLE {quoted(rows_table(table))} ({T.StructType(columns).toDDL()}) USING parquet "
        f"PARTITIONED BY ({quoted_column(GEN)}, {quoted_column(SHARD)}) "
        f"TBLPROPERTIES ('{WIDTH_PROPERTY}' = '{width}')"
    )
    if path is not None:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)
    folder = location(spark, rows_table(table))
    if _latest(spark, folder) is None:
        files.create_new(spark, _version_file(folder, 0), Version(open={}, batches={}).text())
    _show(spark, table, folder, width)


def drop(spark: SparkSession, table: str) -> None:
    """Drop a stored table; the folder of one with a path of its own stays."""
    if not spark.catalog.tableExists(quoted(table)):
        return
    if is_versioned(spark, table):
        spark.sql(f"DROP VIEW IF EXISTS {quoted(table)}")
        spark.sql(f"DROP TABLE IF EXISTS {quoted(rows_table(table))}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")


def _show(spark: SparkSession, table: str, folder: str, width: int) -> None:
    """Point the view at the latest version; whoever comes last sees to it that it is."""
    shown = None
    while shown is None or shown.changes != (now := _latest(spark, folder)).changes:
        shown = _latest(spark, folder) if shown is None else now
        held = spark.table(quoted(rows_table(table))).columns
        listed = ", ".join(quoted_column(c) for c in held if c != GEN)
        escaped = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE OR REPLACE VIEW {quoted(table)} "
            f"TBLPROPERTIES ('{WIDTH_PROPERTY}' = '{width}', '{FOLDER_PROPERTY}' = '{escaped}') "
            f"AS SELECT {listed} FROM {quoted(rows_table(table))} WHERE {shown.predicate()}"
        )


class Stored:
    """A stored table as one writer sees it: the version it read, and its own generation."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        known = properties(spark, table)
        if FOLDER_PROPERTY not in known:
            raise ValueError(f"{table!r} is not a table that write_dataframe made")
        self.folder, self.width = known[FOLDER_PROPERTY], int(known[WIDTH_PROPERTY])
        self.base = _latest(spark, self.folder)
        self._indexed, self._measured = self.base.indexed, self.base.measured

    def rows(self) -> DataFrame:
        """The rows of the version that was read, with their ``$shard``."""
        return self._all().where(self.base.predicate()).drop(GEN)

    def _all(self) -> DataFrame:
        return self.spark.table(quoted(rows_table(self.table)))

    def partitions(self, gen: int | None = None) -> list[tuple[int, int]]:
        """(generation, shard) of the catalog's partitions; no data is read."""
        only = "" if gen is None else f" PARTITION ({quoted_column(GEN)} = {gen})"
        listed = self.spark.sql(f"SHOW PARTITIONS {quoted(rows_table(self.table))}{only}").collect()
        pairs = [row[0].split("/") for row in listed]
        return [(int(g.split("=", 1)[1]), int(s.split("=", 1)[1])) for g, s in pairs]

    def append(self, rows: DataFrame, cluster: bool = True, alone: bool = False, batch=None) -> None:
        """Add *rows*. *alone*: only if nothing was written since this writer read the table.
        *batch*: (stream, number) to remember."""
        self._write(rows, [], alone, cluster, batch)

    def replace(self, rows: DataFrame, replaced: Runs, batch=None) -> None:
        """Put *rows* in the place of all rows in the shards of *replaced*."""
        self._write(rows, replaced, True, True, batch)

    def _write(self, rows: DataFrame, replaced: Runs, alone: bool, cluster: bool, batch) -> None:
        self._collect()
        gen = self._claim()
        try:
            self._insert(gen, rows, cluster)
            while True:
                try:
                    self._commit(gen, replaced, alone, batch)
                    break
                except _Overtaken:  # shards of these rows were replaced by a later generation
                    gen = self._renewed(gen)
        except BaseException:
            self._give_up(gen)
            raise
        _show(self.spark, self.table, self.folder, self.width)

    def _insert(self, gen: int, rows: DataFrame, cluster: bool) -> None:
        name = rows_table(self.table)
        ordered = in_table_order(self._all().drop(GEN).schema, rows)
        self.spark.sql(
            f"INSERT INTO {quoted(name)} PARTITION ({quoted_column(GEN)} = {gen}, {quoted_column(SHARD)}) "
            "SELECT * FROM {rows}",
            rows=clustered(ordered) if cluster else ordered,
        )
        if self._indexed:
            self._index(gen, self._indexed)
        if self._measured:
            self._measure(gen, self._measured)

    def _measure(self, gen: int, columns: Sequence[str]) -> None:
        """Rows of a generation never change, so a row that is there twice counts once."""
        own = moments.built(self._all().where(F.col(GEN) == gen), columns)
        own.write.mode("append").parquet(moments.folder(self.folder, gen))

    def _index(self, gen: int, keys: Sequence[str]) -> None:
        own = keyindex.built(self._all().where(F.col(GEN) == gen), keys)
        own.write.mode("overwrite").parquet(keyindex.folder(self.folder, gen))

    def shards_with(self, batch: DataFrame, keys: Sequence[str]) -> list[int] | None:
        """Shards that may hold a key of *batch*; None if only a scan can tell."""
        if set(keys) != set(self.base.indexed) or batch.limit(keyindex.MOST_KEYS + 1).count() > keyindex.MOST_KEYS:
            return None
        if not files.names_in(self.spark, keyindex.folder(self.folder)):
            return []
        index = self.spark.read.parquet(keyindex.folder(self.folder))
        seen = index.withColumn(SHARD, F.col("shard")).where(self.base.predicate())
        return [r["shard"] for r in keyindex.shards_with(seen, batch, self.base.indexed).collect()]

    def index(self, keys: Sequence[str]) -> None:
        """Keep an index of *keys* from now on, also for the rows that are stored."""
        for gen in sorted({g for g, s in self.partitions() if self.base.sees(g, s)}):
            self._index(gen, keys)

        def indexed(now: Version) -> Version:
            if now.changes != self.base.changes or now.open:
                raise ConcurrentWriteError(f"{self.table!r} was changed while its keys were indexed")
            return replace(now, number=now.number + 1, indexed=tuple(keys))

        _changed(self.spark, self.folder, indexed)

    def measure(self, columns: Sequence[str]) -> None:
        """Keep moments of *columns*, too, from now on, also for the rows that are stored."""
        for gen in sorted({g for g, s in self.partitions() if self.base.sees(g, s)}):
            self._measure(gen, columns)

        def measured(now: Version) -> Version:
            if now.changes != self.base.changes or now.open:
                raise ConcurrentWriteError(f"{self.table!r} was changed while it was measured")
            return replace(now, number=now.number + 1, measured=(*now.measured, *columns))

        _changed(self.spark, self.folder, measured)

    def moments(self) -> DataFrame:
        """(shard, column, n, whole, part, spread) of what the version that was read holds.

        Rows of removed partitions stay in the folder, so those the catalog knows decide.
        """
        schema = "shard bigint, column string, n bigint, whole decimal(38,0), part double, spread double"
        known = [p for p in self.partitions() if self.base.sees(*p)]
        if not known:
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(f"{schema}, {quoted_column(GEN)} bigint").parquet(
            moments.folder(self.folder)
        )
        pairs = self.spark.createDataFrame(known, f"{quoted_column(GEN)} bigint, shard bigint")
        present = stored.join(pairs, [GEN, "shard"], "left_semi")
        return present.dropDuplicates([GEN, "shard", "column"]).drop(GEN)

    def _claim(self) -> int:
        def claimed(now: Version) -> Version:
            gen = now.following
            opened = {**now.open, gen: _micros()}
            return replace(now, number=now.number + 1, following=gen + 1, open=opened)

        version = _changed(self.spark, self.folder, claimed)
        # Neither changes while a generation is open.
        self._indexed, self._measured = version.indexed, version.measured
        return version.following - 1

    def _commit(self, gen: int, replaced: Runs, alone: bool, batch) -> None:
        own = {shard for _, shard in self.partitions(gen)}

        def committed(now: Version) -> Version:
            if gen not in now.open:
                raise ConcurrentWriteError(f"a write to {self.table!r} took longer than its lease")
            if alone and now.changes != self.base.changes:
                raise ConcurrentWriteError(f"{self.table!r} was changed while this write ran")
            for runs, below, _ in now.dead:
                if gen < below and any(a <= s <= b for a, b in runs for s in own):
                    raise _Overtaken
            opened = {g: since for g, since in now.open.items() if g != gen}
            dead = now.dead + (((replaced, gen, _micros()),) if replaced else ())
            return replace(
                now,
                number=now.number + 1,
                changes=now.changes + 1,
                last=max(now.last, gen),
                open=opened,
                dead=dead,
                batches={**now.batches, **({batch[0]: batch[1]} if batch else {})},
            )

        _changed(self.spark, self.folder, committed)

    def _renewed(self, gen: int) -> int:
        """The rows of a generation in one that comes after all others."""
        later = self._claim()
        self._insert(later, self._all().where(F.col(GEN) == gen).drop(GEN), True)
        self._give_up(gen)
        return later

    def _give_up(self, gen: int) -> None:
        def ended(now: Version) -> Version:
            opened = {g: since for g, since in now.open.items() if g != gen}
            return replace(now, number=now.number + 1, open=opened)

        self._drop_partitions(self.partitions(gen))
        _changed(self.spark, self.folder, ended)

    def _collect(self, now: int | None = None) -> None:
        """Remove what no reader is to see any more."""
        moment = _micros() if now is None else now
        before = self.base
        conf = self.spark.conf
        grace = _micros_of(conf.get(GRACE, DEFAULT_GRACE))
        lease = _micros_of(conf.get(LEASE, DEFAULT_LEASE))
        due = [d for d in before.dead if d[2] + grace <= moment]
        late = [g for g, since in before.open.items() if since + lease <= moment]
        if not due and not late:
            return
        if late:

            def lost(now: Version) -> Version:
                opened = {g: since for g, since in now.open.items() if g not in late}
                gone = (*now.lost, *(g for g in late if g in now.open))
                return replace(now, number=now.number + 1, open=opened, lost=gone)

            before = _changed(self.spark, self.folder, lost)
        covered = lambda runs, s: any(a <= s <= b for a, b in runs)
        gone = [
            (g, s)
            for g, s in self.partitions()
            if g in late or any(
                g < below and covered(runs, s) and g not in before.open for runs, below, _ in due
            )
        ]
        self._drop_partitions(gone)

        def cleaned(now: Version) -> Version:
            left = tuple(d for d in now.dead if d not in due)
            return replace(now, number=now.number + 1, dead=left)

        _changed(self.spark, self.folder, cleaned)

    def _drop_partitions(self, pairs: list[tuple[int, int]]) -> None:
        name, listed = quoted(rows_table(self.table)), sorted(pairs)
        for start in range(0, len(listed), PARTITIONS_PER_STATEMENT):
            some = listed[start : start + PARTITIONS_PER_STATEMENT]
            specs = ", ".join(
                f"PARTITION ({quoted_column(GEN)} = {g}, {quoted_column(SHARD)} = {s})" for g, s in some
            )
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")
        left = {g for g, _ in self.partitions()} if listed else set()
        for gen in {g for g, _ in listed}:
            if gen not in left:  # a folder of its own outlives the catalog's partitions
                files.remove(self.spark, f"{self.folder}/{GEN}={gen}")
                files.remove(self.spark, keyindex.folder(self.folder, gen))
                files.remove(self.spark, moments.folder(self.folder, gen))
        for gen, shard in listed:
            if gen in left:
                files.remove(self.spark, f"{self.folder}/{GEN}={gen}/{SHARD}={shard}")


class _Overtaken(Exception):
    pass


def _micros_of(width: str) -> int:
    return 0 if width.strip().rstrip("smhdw") == "0" else width_micros(width)


def stored_shards(spark: SparkSession, table: str) -> list[int | None]:
    """Shards that hold rows; no data is read. ``None`` stands for rows without a time, which
    only materialised results can have."""
    if not is_versioned(spark, table):
        return plain_shards(spark, table)
    stored = Stored(spark, table)
    return sorted({s for g, s in stored.partitions() if stored.base.sees(g, s)})


def remove_replaced(spark: SparkSession, table: str) -> None:
    """Remove replaced rows whose grace time is over; every write does so, too."""
    Stored(spark, table)._collect()


def index_keys(spark: SparkSession, table: str, keys: Sequence[str]) -> None:
    """Keep, for each shard of each write, what tells whether it can hold a value of *keys*.

    Deduplicating writes by these columns then open only the shards that can hold a key of
    their batch. Writes of unindexed keys and large batches scan the stored keys as before.
    """
    stored = Stored(spark, table)
    unknown = [k for k in keys if k not in stored.rows().columns]
    if unknown or not keys or AXIS in keys:
        raise ValueError(f"name stored columns other than {AXIS!r} to index; got {list(keys)}")
    stored.index(list(keys))


def measure_columns(spark: SparkSession, table: str, columns: Sequence[str]) -> None:
    """Keep count, sum and deviation of *columns* for each shard of each write.

    ``stored_stats`` then answers without a scan, whatever is written later. It takes one
    pass over the columns of what is stored, and later one over those of each write.
    """
    stored = Stored(spark, table)
    wrong = moments.not_numbers(stored.rows().drop(SHARD).schema, columns)
    if wrong or not columns:
        raise ValueError(f"name stored columns of numbers to measure; got {list(columns)}")
    if fresh := [c for c in dict.fromkeys(columns) if c not in stored.base.measured]:
        stored.measure(fresh)


def stored_stats(spark: SparkSession, table: str, *columns: str, ranges=None) -> DataFrame:
    """What ``global_stats`` says of a measured table, from its stored moments.

    No row is read. With *ranges* (half-open, as in ``read_ranges``) rows of the shards that
    a range covers in part are read, and moments answer for the others. The frame describes
    the version that was there at the call; sums of fractions can differ from those of a
    scan in the last bits, as the order of addition does.
    """
    while True:
        stored = Stored(spark, table)
        if unknown := [c for c in columns if c not in stored.base.measured]:
            raise ValueError(f"columns {unknown} of {table!r} are not measured")
        held = stored.moments()
        if _latest(spark, stored.folder).changes == stored.base.changes:
            break  # no partition was removed between the version and the listing
    held = held.where(F.col("column").isin(list(columns)))
    if ranges is not None:
        spans, width = merged_ranges(ranges), stored.width
        full = [(-(-lo // width), hi // width - 1) for lo, hi in spans if hi // width > -(-lo // width)]
        ends = {s for lo, hi in spans for s in (lo // width, (hi - 1) // width)}
        ends = sorted(s for s in ends if not any(a <= s <= b for a, b in full))
        inside = [F.col("shard").between(a, b) for a, b in full]
        edges = stored.rows().where(F.col(SHARD).isin(ends) & within(spans))
        held = held.where(any_of(inside)).unionByName(moments.built(edges, columns))
    return moments.merged(held, columns, stored.rows().schema)


def compact_table(spark: SparkSession, table: str, most: int = 1) -> None:
    """Write the shards that hold more than *most* generations anew as one each.

    Every write adds a generation, so a shard that many small batches went to has many
    folders. Rows stay as they are, and readers notice nothing.
    """
    stored = Stored(spark, table)
    held: dict[int, int] = {}
    for gen, shard in stored.partitions():
        if stored.base.sees(gen, shard):
            held[shard] = held.get(shard, 0) + 1
    runs = runs_of(s for s, n in held.items() if n > most)
    if runs:
        inside = F.lit(False)
        for a, b in runs:
            inside = inside | F.col(SHARD).between(a, b)
        stored.replace(stored.rows().where(inside), runs)
