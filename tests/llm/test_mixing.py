"""Mixing against a plain version."""

import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from tickshard.llm import mixing

DOCS = "doc_id bigint, text string, source string, size string"


def plain_targets(sizes, weights=(5, 2, 1)):
    """Shares by weight; what is above three times a source's size is shared anew."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: Fraction(weight[s] * left, sum(weight[o] for o in open_)) for s in open_}
        above = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not above:
            return {s: float(share.get(s, 3 * sizes[s])) for s in names}
        full |= above
        if len(full) == len(names):
            return {s: 3.0 * sizes[s] for s in names}


def made(rng):
    docs = [(i, " ".join(["w"] * rng.randrange(1, 200)), rng.choice(["a", "b", "é", "z", None]), "x")
            for i in range(400)]
    docs += [(i, "one two", "tiny", "x") for i in range(500, 503)]
    docs += [(9, "copy of a row", "hot", "x")] * 300
    docs += [(600, None, "a", "x"), (601, "", "empty", "x"), (602, " \t", None, "x"), (None, "no id", "b", "x"),
             (None, "no id", "b", "x"), (603, "w x " * 5000, "z", "x")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("cell", [20_000, 15])
def test_targets_and_taken_words(frame, monkeypatch, cell):
    monkeypatch.setattr(mixing, "CELL", cell)
    monkeypatch.setattr(mixing, "UNFOLD", 64)
    docs = made(random.Random(1))
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for _, t, s, _ in docs:
        sizes[s] += size(t)
    targets = plain_targets(sizes)
    table = frame(docs, DOCS).repartition(6)
    found = mixing.assign(table).collect()
    assert Counter((r.doc_id, r.size, r.source, r.source_size, r.target) for r in found) == Counter(
        (i, size(t), s, sizes[s], targets[s]) for i, t, s, _ in docs)
    taken = Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(c.words for c in r.copies)
        assert all(0 < c.words <= r.size and 0 <= c.position <= sum(sizes.values()) + 1 for c in r.copies)
        taken[r.source] += r.taken
    assert taken == {s: int(t) for s, t in targets.items()}
    again = mixing.assign(frame(docs[::-1], DOCS).repartition(3)).collect()
    key = lambda r: repr((r.doc_id, r.source, r.taken, r.copies))
    assert sorted(map(key, found)) == sorted(map(key, again))


@pytest.mark.parametrize("words", [429_496_729, 429_496_730, (1 << 31) - 1, 1 << 31, 10**18])
def test_targets_of_many_words(frame, words):
    # 5 times the words is no int from the second on; the words themselves are one up to the third
    sizes = {"a": words // 2, "b": words // 4, None: words - words // 2 - words // 4}
    rows = [(s, size, weight) for (s, size), weight in zip(sizes.items(), (5, 2, 1))]
    found = mixing.targets(frame(rows, "source string, source_size bigint, weight int")).collect()
    assert {r.source: r.target for r in found} == pytest.approx(plain_targets(sizes), rel=1e-15)


def test_mix_follows_the_schedules(frame):
    docs = [(i, " ".join([f"w{i}"] * 10), s, "x") for i, s in enumerate(["a", "b", "c"] * 2000)]
    rows = mixing.mix(frame(docs, DOCS), weights=(1, 1, 1)).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert all(r.text == " ".join([f"w{r.doc_id}"] * 10) for r in rows)
    share = lambda s, part: sum(r.words for r in part if r.source == s) / sum(r.words for r in part)
    tenth = len(rows) // 10
    first, last = rows[:tenth], rows[-tenth:]
    # rates at time 0.05: 1.45, 1, 0.30 of 0.75 + ...; the third schedule's integral is 1
    assert abs(share("a", first) - 1.45 / 2.75) < 0.03 and abs(share("a", last) - 0.55 / 3.65) < 0.03
    assert share("c", first) < 0.13 and share("c", last) > 0.55
    # the integral of all rates up to a position is the words before it
    before = 0
    for r in rows:
        assert abs(r.position - before) < 60
        before += r.words


def test_demand_and_its_inverse(spark):
    from pyspark.sql import functions as F

    for schedule in [*mixing.SCHEDULES, ((0, 0), (0.25, 0), (0.5, 4), (0.75, 0), (1, 0))]:
        demand = mixing.Demand(schedule)
        share = F.col("id") / 100
        rows = spark.range(101).select(share.alias("share"), demand.at(demand.time(share)).alias("back")).collect()
        assert all(abs(r.share - r.back) < 1e-9 for r in rows)
    for bad in [((0, 1), (0.9, 1)), ((0, 1), (1, -1)), ((0, 0), (1, 0))]:
        with pytest.raises(ValueError):
            mixing.Demand(bad)


def test_mixing_edges(frame):
    assert mixing.assign(frame([], DOCS)).count() == 0
    nothing = mixing.assign(frame([(1, None, "a", "x"), (2, "", None, "x")], DOCS)).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in nothing) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    only = mixing.in_order(mixing.assign(frame([(1, "a b", None, "x")], DOCS))).collect()
    assert [(r.target, r.taken) for r in only] == [(2.0, 2)]
    with pytest.raises(ValueError, match="size"):
        mixing.assign(frame([(1, "a", "s", "x")], DOCS), carried=["size"])
