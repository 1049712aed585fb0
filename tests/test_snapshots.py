"""Writes that show up at once: readers, other writers and lost drivers in between."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tickshard as ts
from tickshard.plans import keyindex, rewrite, snapshots
from tickshard.plans.snapshots import Stored, Version, rows_table, runs_of

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)
UPSERT = {"deduplicate": ["x"], "deduplication_mode": "upsert"}


def days(spark, numbers, v=0):
    rows = [(START + n * DAY + dt.timedelta(hours=1), n, v) for n in numbers]
    return spark.createDataFrame(rows, "`$timestamp` timestamp_ntz, x bigint, v bigint")


def held(frame):
    return sorted((r.x, r.v) for r in frame.collect())


@pytest.fixture
def no_grace(spark):
    spark.conf.set("tickshard.grace", "0s")
    yield
    spark.conf.unset("tickshard.grace")


@pytest.mark.parametrize("folder", [True, False])
def test_a_reader_keeps_what_it_began_with(spark, table_name, tmp_path, folder):
    path = str(tmp_path / "t") if folder else None
    ts.write_dataframe(days(spark, range(6)), table_name, path=path).compute()
    readers = [ts.read_table(spark, table_name), ts.query(spark, f'SELECT x, v FROM "{table_name}"')]
    started = readers[0].toLocalIterator()
    first = next(started)
    ts.write_dataframe(days(spark, [1, 2, 9], v=1), table_name, **UPSERT).compute()
    ts.write_dataframe(days(spark, [3, 5], v=2), table_name, push_mode="truncate").compute()
    old = [(n, 0) for n in range(6)]
    assert sorted([(first.x, first.v), *((r.x, r.v) for r in started)]) == old
    for reader in readers:  # also when it runs again
        assert held(reader) == old
    new = [(0, 0), (1, 1), (2, 1), (3, 2), (5, 2), (9, 1)]
    assert held(ts.read_table(spark, table_name)) == new
    ranges = [(START, START + 4 * DAY)]
    assert held(ts.read_ranges(spark, table=table_name, ranges=ranges)) == new[:4]


@pytest.mark.parametrize("options", [UPSERT, {"push_mode": "truncate"}, {"deduplicate": ["x"]}])
def test_of_two_writers_that_replace_one_wins(spark, table_name, monkeypatch, options):
    ts.write_dataframe(days(spark, range(4)), table_name).compute()
    insert, other = Stored._insert, [days(spark, [2], v=7)]

    def slow(self, gen, rows, cluster):
        insert(self, gen, rows, cluster)
        if other:  # another writer begins later and ends earlier
            ts.write_dataframe(other.pop(), table_name, **UPSERT).compute()

    with monkeypatch.context() as patched:
        patched.setattr(Stored, "_insert", slow)
        with pytest.raises(ts.ConcurrentWriteError, match="was changed"):
            ts.write_dataframe(days(spark, [1, 3, 8], v=5), table_name, **options).compute()
    assert held(ts.read_table(spark, table_name)) == [(0, 0), (1, 0), (2, 7), (3, 0)]
    ts.write_dataframe(days(spark, [1, 3], v=5), table_name, **UPSERT).compute()
    assert held(ts.read_table(spark, table_name)) == [(0, 0), (1, 5), (2, 7), (3, 5)]


def test_appends_go_on_after_others(spark, table_name, monkeypatch):
    ts.write_dataframe(days(spark, range(3)), table_name).compute()
    insert = Stored._insert
    others = [({}, days(spark, [5], v=1)), (UPSERT, days(spark, [1], v=2)),
              ({"push_mode": "truncate"}, days(spark, [7, 9], v=3))]

    def slow(self, gen, rows, cluster):
        insert(self, gen, rows, cluster)
        now, others[:] = others[:], []
        for options, rows in now:
            ts.write_dataframe(rows, table_name, **options).compute()

    with monkeypatch.context() as patched:
        patched.setattr(Stored, "_insert", slow)
        ts.write_dataframe(days(spark, [1, 8], v=9), table_name).compute()
    # the append comes after the upsert of day 1 and the truncation of days 7 to 9
    assert held(ts.read_table(spark, table_name)) == [
        (0, 0), (1, 2), (1, 9), (2, 0), (5, 1), (7, 3), (8, 9), (9, 3)]


@pytest.mark.parametrize("step", ["_insert", "_commit"])
@pytest.mark.parametrize("options", [{}, UPSERT, {"push_mode": "truncate"}])
def test_a_driver_that_dies_leaves_the_old_version(spark, table_name, monkeypatch, step, options):
    ts.write_dataframe(days(spark, range(6)), table_name).compute()

    class Killed(BaseException):
        pass

    def dies(self, *args):
        if step == "_insert":
            insert(self, *args)
        raise Killed

    insert = Stored._insert
    with monkeypatch.context() as patched:
        patched.setattr(Stored, step, dies)
        patched.setattr(Stored, "_give_up", lambda self, gen: None)  # nobody is left to tidy up
        with pytest.raises(Killed):
            ts.write_dataframe(days(spark, [1, 4], v=1), table_name, **options).compute()
    assert held(ts.read_table(spark, table_name)) == [(n, 0) for n in range(6)]
    ts.write_dataframe(days(spark, [7], v=2), table_name).compute()
    assert held(ts.read_table(spark, table_name)) == [*((n, 0) for n in range(6)), (7, 2)]
    spark.conf.set("tickshard.lease", "0s")
    try:
        ts.remove_replaced(spark, table_name)
    finally:
        spark.conf.unset("tickshard.lease")
    assert {g for g, _ in Stored(spark, table_name).partitions()} == {1, 3}
    assert held(ts.read_table(spark, table_name)) == [*((n, 0) for n in range(6)), (7, 2)]


def test_a_driver_that_dies_before_the_view_is_replaced(spark, table_name, monkeypatch):
    ts.write_dataframe(days(spark, range(3)), table_name).compute()

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "_show", dies)
        with pytest.raises(KeyboardInterrupt):
            ts.write_dataframe(days(spark, [1], v=4), table_name, **UPSERT).compute()
    assert held(ts.read_table(spark, table_name)) == [(0, 0), (1, 0), (2, 0)]
    ts.write_dataframe(days(spark, [2], v=5), table_name, **UPSERT).compute()
    assert held(ts.read_table(spark, table_name)) == [(0, 0), (1, 4), (2, 5)]


def test_nothing_is_left_over_after_ten_upserts(spark, table_name, tmp_path, no_grace):
    ts.write_dataframe(days(spark, range(4)), table_name, path=str(tmp_path / "t")).compute()
    for turn in range(10):
        ts.write_dataframe(days(spark, [1, 2], v=turn), table_name, **UPSERT).compute()
    ts.remove_replaced(spark, table_name)
    folders = {str(f.parent.relative_to(tmp_path / "t")) for f in Path(tmp_path).rglob("*.parquet")}
    assert len(folders) == 4 and len({f.split("/")[0] for f in folders}) == 2
    assert {f.name for f in (tmp_path / "t").glob("$gen=*")} == {f.split("/")[0] for f in folders}
    assert len(list((tmp_path / "t" / "_versions").glob("*.json"))) <= snapshots.KEPT_VERSIONS
    assert held(ts.read_table(spark, table_name)) == [(0, 0), (1, 9), (2, 9), (3, 0)]
    assert not Stored(spark, table_name).base.dead


def test_calls_do_not_grow_with_earlier_writes(spark, table_name, monkeypatch, no_grace):
    """Statements and file-system calls of a write, after two writes and after twelve."""
    ts.write_dataframe(days(spark, range(5)), table_name).compute()
    made = []
    sql = type(spark).sql
    system = snapshots.files._system
    counts = []
    for turn in range(12):
        made.clear()
        with monkeypatch.context() as patched:
            patched.setattr(type(spark), "sql", lambda s, q, *a, **k: made.append(q) or sql(s, q, *a, **k))
            patched.setattr(snapshots.files, "_system", lambda *a: made.append("file") or system(*a))
            ts.write_dataframe(days(spark, [1, 3], v=turn), table_name, **UPSERT).compute()
        counts.append(len(made))
        assert sum("CREATE OR REPLACE VIEW" in q for q in made) == 1
    assert max(counts[2:]) <= counts[1] + 4  # the removal of an old version's file


def test_compaction_keeps_rows(spark, table_name, no_grace):
    for turn in range(5):
        ts.write_dataframe(days(spark, [0, turn], v=turn), table_name).compute()
    before = held(ts.read_table(spark, table_name))
    ts.compact_table(spark, table_name)
    ts.remove_replaced(spark, table_name)
    stored = Stored(spark, table_name)
    shards = [s for _, s in stored.partitions()]
    assert len(shards) == len(set(shards)) == 5 and held(ts.read_table(spark, table_name)) == before
    ts.compact_table(spark, table_name)
    assert stored.base.changes == Stored(spark, table_name).base.changes


def test_the_predicate_prunes_partitions(spark, table_name):
    ts.write_dataframe(days(spark, range(5)), table_name).compute()
    ts.write_dataframe(days(spark, [2], v=1), table_name, **UPSERT).compute()
    plan = ts.read_table(spark, table_name)._jdf.queryExecution().executedPlan().toString()
    assert "$gen" in plan.split("PartitionFilters")[1].split("]")[0] and "Exchange" not in plan
    assert spark.table(rows_table(table_name)).count() == 6  # old rows are there, and not read
    assert len(ts.read_table(spark, table_name).inputFiles()) >= 5


def test_dropped_tables_can_be_made_again(spark, table_name, tmp_path):
    for _ in range(2):
        ts.write_dataframe(days(spark, [1]), table_name, path=str(tmp_path / "t")).compute()
        assert held(ts.read_table(spark, table_name)) == [(1, 0)]
        ts.drop_table(spark, table_name)
        assert not spark.catalog.tableExists(table_name)
    ts.drop_table(spark, table_name)


def opened(spark, monkeypatch, write):
    """Shards of the stored rows that a write's search for keys may open."""
    seen = []
    probe = rewrite._candidates

    def watched(table, *args):
        found = probe(table, *args)
        seen.append({f.rsplit("shard=", 1)[1].split("/")[0] for f in found.inputFiles()})
        return found

    with monkeypatch.context() as patched:
        patched.setattr(rewrite, "_candidates", watched)
        write.compute()
    return {int(s) for s in seen[0]}


@pytest.mark.parametrize("mode", ["upsert", "drop"])
def test_an_index_opens_only_shards_that_can_hold_a_key(spark, table_name, monkeypatch, mode):
    first = START.date().toordinal() - dt.date(1970, 1, 1).toordinal()
    keys = {"deduplicate": ["k", "x"], "deduplication_mode": mode}
    key = F.xxhash64(F.lit(3), "x").cast("string").alias("k")  # no order in time
    frame = lambda *a, **k: days(spark, *a, **k).withColumn("k", key)
    ts.write_dataframe(frame(range(40)), table_name).compute()
    ts.index_keys(spark, table_name, ["k", "x"])
    ts.write_dataframe(frame(range(40, 60)), table_name).compute()
    moved = frame([5, 45], v=1).withColumn("$timestamp", F.col("$timestamp") + F.expr("INTERVAL 90 DAYS"))
    none = moved.withColumn("k", F.lit(None).cast("string"))
    write = ts.write_dataframe(moved.unionByName(none), table_name, **keys)
    assert opened(spark, monkeypatch, write) == {first + 5, first + 45}
    wanted = [(n, 0) for n in range(60)]
    if mode == "upsert":
        wanted = sorted(wanted[:5] + wanted[6:45] + wanted[46:] + [(5, 1), (45, 1)])
    assert held(ts.read_table(spark, table_name)) == sorted(wanted + [(5, 1), (45, 1)])
    again = ts.write_dataframe(none, table_name, **keys)
    assert opened(spark, monkeypatch, again) == {first + 95, first + 135}
    assert held(ts.read_table(spark, table_name)) == sorted(wanted + [(5, 1), (45, 1)])
    # a batch beyond the limit scans, and finds the same
    monkeypatch.setattr(keyindex, "MOST_KEYS", 1)
    many = ts.write_dataframe(moved.unionByName(none), table_name, **keys)
    assert len(opened(spark, monkeypatch, many)) >= 60
    assert held(ts.read_table(spark, table_name)) == sorted(wanted + [(5, 1), (45, 1)])
    with pytest.raises(ValueError):
        ts.index_keys(spark, table_name, ["$timestamp"])


def test_large_shards_have_filters_of_many_blocks(spark):
    rows = spark.range(20_000).select(F.lit(3).alias("$shard"), (F.col("id") * 7).alias("x"))
    index = keyindex.built(rows, ["x"]).cache()
    assert {r.level for r in index.collect()} == {5} and index.count() == 32
    hit = lambda *x: [r.shard for r in keyindex.shards_with(
        index, spark.createDataFrame([(i,) for i in x], "x bigint"), ["x"]).collect()]
    assert hit(7 * 19_999) == [3] and hit(0) == [3] and hit(-7) == [] and hit(7 * 20_000) == []
    assert sum(bool(hit(*range(start, start + 70, 7))) for start in range(1, 1400, 140)) <= 1
    assert all(hit(7 * i) for i in range(0, 20_000, 2_500))


def test_versions_as_text():
    version = Version(3, 2, 5, 7, {6: 1}, (4,), (([[1, 2], [5, 5]], 3, 9),), {"s": 4}, ("x",))
    assert Version.of(version.text()) == version and version.hidden() == [4]
    seen = {(g, s) for g in range(8) for s in range(7) if version.sees(g, s)}
    assert seen == {(g, s) for g in (0, 1, 2, 3, 5) for s in range(7) if g >= 3 or s not in (1, 2, 5)}
    assert runs_of([3, 1, 2, 9, 2]) == [[1, 3], [9, 9]]
