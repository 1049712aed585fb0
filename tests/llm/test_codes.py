"""Vector codes and lexical search against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tickshard.llm import codes, lexical

# -- codes -------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label string, code string"


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """Whole scans in Python numbers."""
    good = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab, *_ in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(good[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in good[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, book: min(range(len(book)), key=lambda e: (square(v, book[e]), e))
    for turn in range(rounds + 1):
        coded = [[nearest(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in good]
        for p in range(parts) if turn < rounds else ():
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), code in zip(good, coded) if code[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    errors = [sum(square(cut(v, p), books[p][code[p]]) for p in range(parts))
              for (_, v, _), code in zip(good, coded)]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(flat.encode()).hexdigest()
    by_label = {}
    for (_, _, lab), e in zip(good, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(
        ((i, "".join(f"{e:02x}" for e in code), e, by_label[lab], digest, lab)
         for (i, _, lab), code, e in zip(good, coded, errors)), key=repr)


@pytest.mark.parametrize("spread", [0.01, 0.5, 2e6])
def test_codes_are_those_of_whole_scans(frame, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 32)) * spread
    rows = [(i, (centres[rng.integers(30)] + rng.normal(size=32) * spread / 20).tolist(), f"l{i % 7}", "x")
            for i in range(300)]
    rows += [(1000 + i, rows[5][1], "hot", "x") for i in range(150)]  # copies, and ties between entries
    rows += [(7, rows[9][1], None, "x"), (None, rows[3][1], None, "x"), (400, None, "l1", "x"),
             (401, [None] + rows[0][1][1:], "l1", "x"), (402, [float("nan")] * 32, "l1", "x"),
             (403, [float("-inf")] * 32, None, "x"), (404, [], "l1", "x")]
    found = codes.compress(frame(rows[:-1], VECTORS))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_codes(rows[:-1])
    with pytest.raises(ValueError, match="length"):
        codes.compress(frame(rows, VECTORS))


def test_few_and_no_vectors(frame):
    few = [(2, [1.0] * 16, "a", "x"), (1, [2.0] * 16, "a", "x"), (1, [2.0] * 16, None, "x")]
    found = codes.compress(frame(few, VECTORS)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_codes(few)
    assert codes.compress(frame([], VECTORS)).count() == 0
    assert codes.compress(frame([(1, None, "a", "x")], VECTORS)).count() == 0
    empty = codes.compress(frame([(1, [], "a", "x")], VECTORS)).collect()
    assert [(r.code, r.error) for r in empty] == [("00" * 16, 0)]
    with pytest.raises(Exception, match="does not fit|too large"):
        codes.compress(frame([(1, [1e30] * 16, "a", "x")], VECTORS)).collect()


def test_bounds_save_scans_and_use_the_net_move():
    """An entry that moves away and back has not moved, whatever its path was."""
    rng = np.random.default_rng(4)
    book = rng.integers(-1000, 1000, size=(1, 8, 4))
    x = np.repeat(book[0], 50, axis=0)[:, None, :] + rng.integers(-5, 5, size=(400, 1, 4))
    state = codes.Bounds.none(400, 1)
    state.assign(x, book[None])
    assert state.scanned == 400
    away = book + 5000
    state.scanned = 0
    state.assign(x, np.stack([book, away, book]))  # rounds 0 and 2 are alike
    assert state.scanned == 0
    state.assign(x, np.stack([book, away, away + rng.integers(0, 3000, size=book.shape)]))
    plain = ((x[:, 0, None, :] - state_book(book, away, x, state)) ** 2).sum(axis=2).argmin(axis=1)
    assert (state.code[:, 0] == plain).all()


def state_book(book, away, x, state):
    """The last codebook of the test above: made from the same numbers."""
    rng = np.random.default_rng(4)
    rng.integers(-1000, 1000, size=book.shape)
    rng.integers(-5, 5, size=(400, 1, 4))
    return (away + rng.integers(0, 3000, size=book.shape))[0]


def test_net_moves_keep_codes_exact_over_many_rounds():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, size=(500, 2, 3))
    history = rng.integers(-300, 300, size=(1, 2, 12, 3))
    state = codes.Bounds.none(500, 2)
    for step in (0, 3, 40, 3, 0, 200, 1, 1, 1):
        if step:
            move = rng.integers(-step, step + 1, size=history[-1].shape)
            history = np.concatenate([history, (history[-1] + move)[None]])
        state.assign(x, history)
        for p in range(2):
            squares = ((x[:, p, None, :] - history[-1][p][None]) ** 2).sum(axis=2)
            assert (state.code[:, p] == squares.argmin(axis=1)).all()
    assert state.scanned < 9 * 1000


# -- lexical search ----------------------------------------------------------------

TEXT = "doc_id bigint, text string, score string"
ITEMS = "item_id bigint, text string, doc_id string"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def plain_search(docs, items, k=10):
    held = [(i, t) for i, t in ((i, plain_terms(text)) for i, text, *_ in docs) if t]
    n, length, df = len(held), sum(len(t) for _, t in held), {}
    for _, t in held:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text, *_ in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for i, t in held:
            m = 10 + 90 * len(t) * n // length
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                * (1_000_000_000 * t.count(term) // (1000 * t.count(term) + 8 * m))
                for term in own if term in t)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("docs_in_block", [1 << 14, 17])
def test_ranks_are_those_of_whole_scoring(frame, monkeypatch, docs_in_block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs_in_block)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "x9", "日本"]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(rng.randrange(1, 60)), "z") for i in range(300)]
    docs += [(i, docs[4][1].upper(), "z") for i in range(300, 420)]  # a third are alike
    docs += [(None, docs[4][1], "z"), (4, text(9), "z"), (500, None, "z"), (501, "", "z"), (502, "!?", "z"),
             (503, " ".join(words * 3000), "z")]
    rng.shuffle(docs)
    items = [(i, text(12) + ", only here", "q") for i in range(25)]
    items += [(3, "w1 w50", "q"), (None, "É.w7", "q"), (None, "w9", "q"), (90, None, "q"), (91, "", "q"),
              (92, "nothing", "q"), (93, docs[0][1] or "w1", "q")]
    found = lexical.rank_documents(frame(docs, TEXT).repartition(5), frame(items, ITEMS)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_search(docs, items)


def test_items_in_several_turns(frame, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 60)
    docs = [(i, f"a{i % 3} b{i % 5} c{i % 7}", "z") for i in range(40)]
    items = [(i, f"a{i % 3} c{i % 7} d", "q") for i in range(9)]
    found = lexical.rank_documents(frame(docs, TEXT), frame(items, ITEMS), k=4).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_search(docs, items, 4)


def test_empty_tables_have_no_ranks(frame):
    docs, items = [(1, "a b", "z")], [(1, "a", "q")]
    assert lexical.rank_documents(frame([], TEXT), frame(items, ITEMS)).count() == 0
    assert lexical.rank_documents(frame(docs, TEXT), frame([], ITEMS)).count() == 0
    assert lexical.rank_documents(frame([(1, None, "z")], TEXT), frame(items, ITEMS)).count() == 0


def test_accumulators_are_limited_and_survivors_exact():
    """Documents with only the frequent term get none once ten others are out of reach."""
    n = np.full(1000, 20)
    sizes = np.where(np.arange(1000) < 20, 2, 1)
    term = np.concatenate([[0, 1] * 20, [1] * 980]).astype(np.int64)
    block = lexical.Block(n, sizes, term, np.ones(len(term), dtype=np.int64), (1000, 20_000), 2)
    weight = np.array([4000, 10])
    scores = lexical.accumulate(block, np.array([0, 1]), weight, 10, np.zeros(0, dtype=np.int64))
    part = block.part[0]
    assert (scores[:20] == 4010 * part).all() and not scores[20:].any()
    best = np.full(10, 10**12)
    assert not lexical.accumulate(block, np.array([0, 1]), weight, 10, best).any()
