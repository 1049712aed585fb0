"""Near-duplicates against all pairs compared by brute force."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickshard.llm import near
from tickshard.llm.components import components
from tickshard.llm.near import near_duplicates
from tickshard.llm.scratch import Scratch

_WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, k):
    words = _WORD.findall(lowered(text))
    if not words:
        return frozenset()
    n = max(1, len(words) - k + 1)
    return frozenset(tuple(words[i : i + k]) for i in range(n))


def brute(rows, k):
    sets = {d: shingle_set(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    by_size = sorted(ids, key=lambda d: len(sets[d]))
    for i, a in enumerate(by_size):
        for b in by_size[i + 1 :]:
            if len(sets[a]) * 100 < len(sets[b]) * 80:
                break
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(d, len(sets[d]), find(d), find(d) == d) for d in ids}


def found(df, k):
    return {tuple(r) for r in near_duplicates(df, k).collect()}


@pytest.mark.parametrize("k", [2, 5])
def test_tables(spark, k):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, k) == brute(rows, k)


def near_copies(n, edits, seed=3):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i * 3, " ".join(words)))
    return rows


def test_large_group_in_blocks(spark, frame, monkeypatch):
    """A group in which some pairs are linked and some are not, cut into many blocks."""
    monkeypatch.setattr(near, "BLOCK", 20)
    monkeypatch.setattr(near, "SHORT_LIST", 4)
    rows = near_copies(150, 14) + [(1000 + i, t) for i, (_, t) in enumerate(near_copies(40, 3, 8))]
    assert found(frame(rows, "doc_id bigint, text string"), 2) == brute(rows, 2)


def test_edges(frame):
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "one"),
        (5, "ONE "),
        (6, "one two"),
        (7, "one two"),
        (8, "a b c d " * 4000),
        (9, "a b c d " * 3000 + "A b"),
        (10, "É b c"),
        (11, "é b c"),
        (-5, "x y z"),
        (12, "x  y\nz"),
    ]
    schema = "doc_id bigint, text string"
    assert found(frame(rows, schema), 2) == brute(rows, 2)
    more = frame([(d, t, "x", 1) for d, t in rows], f"{schema}, component_id string, n int")
    assert found(more, 2) == brute(rows, 2)
    assert found(frame([], schema), 2) == set()
    assert found(frame([(None, "a b c"), (1, "a b c"), (None, None)], schema), 2) == {
        (None, 2, None, True),
        (1, 2, 1, True),
        (None, 0, None, True),
    }
    assert found(frame([(4, "a b c"), (4, "a b c")], schema), 2) == {(4, 2, 4, True)}


def twins(n):
    """Two words of *n* letters that a polynomial modulo 2**64 can't tell apart from 1,024 on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return ["".join("ab"[b] for b in bits), "".join("ab"[1 - b] for b in bits)]


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_mirror_each_other_are_different(frame, n):
    one, two = twins(n)
    rows = [(1, f"{one} end"), (2, f"{two} end"), (3, f"{one}  END")]
    assert found(frame(rows, "doc_id bigint, text string"), 5) == {
        (1, 1, 1, True), (2, 1, 2, True), (3, 1, 1, False)}


def test_ids_with_several_texts_keep_all_links(frame):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "ab"]
    close = [t + " more" for t in texts]
    rows = [(1, texts[0]), (1, texts[1]), (2, close[0]), (3, close[1]), (4, "something else")]
    got = near_duplicates(frame(rows, "doc_id bigint, text string"), 2).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)} and len(got) == 5


def test_a_task_of_a_long_list_holds_few_shingles(spark, monkeypatch):
    """Few members with large sets are cut into blocks, too."""
    monkeypatch.setattr(near, "SHORT_LIST", 4)
    monkeypatch.setattr(near, "BLOCK_ITEMS", 1000, raising=False)
    held = lambda left: pa.table({"a": [left.num_rows], "b": [sum(map(len, left.column("items").to_pylist()))]})
    monkeypatch.setattr(near, "_forest", held)
    reps = spark.range(100).withColumnRenamed("id", "rep")
    members = reps.selectExpr("1L AS value", "rep", "100L AS n", "100L AS length")
    sets = reps.select("rep", F.sequence(F.col("rep"), F.col("rep") + 99).alias("items"))
    labels = spark.createDataFrame([], "rep bigint, comp bigint")
    tasks = near._long_list_links(members, labels, sets).collect()
    assert sum(t.b for t in tasks) == 10 * 100 * 100  # ten blocks: each member meets all of them
    assert len(tasks) == 55 and max(t.b for t in tasks) <= 5000


@pytest.mark.parametrize("items", [300, 2000])
def test_blocks_by_shingles_lose_no_link(frame, monkeypatch, items):
    monkeypatch.setattr(near, "SHORT_LIST", 4)
    monkeypatch.setattr(near, "BLOCK_ITEMS", items, raising=False)
    rows = near_copies(80, 14) + [(1000 + i, t) for i, (_, t) in enumerate(near_copies(30, 3, 8))]
    assert found(frame(rows, "doc_id bigint, text string"), 2) == brute(rows, 2)


def test_groups_are_contracted_once(frame, monkeypatch):
    """Links that lists add join groups; the links inside these are not worked through again."""
    monkeypatch.setattr(near, "SHORT_LIST", 4)
    given, stored = [], []
    store = Scratch.store

    def noted(edges, scratch):
        given.append({tuple(r) for r in edges.collect()})
        before = len(stored)
        labels = components(edges, scratch)
        assert (len(stored) - before) % 3 == 0  # a round stores three tables, nothing else is
        return labels

    monkeypatch.setattr(Scratch, "store", lambda self, df: stored.append(1) or store(self, df))
    monkeypatch.setattr(near, "components", noted)
    rows = near_copies(150, 14)
    assert found(frame(rows, "doc_id bigint, text string"), 2) == brute(rows, 2)
    assert len(given) == 2 and given[1] and not given[0] & given[1]
