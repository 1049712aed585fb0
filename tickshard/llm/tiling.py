"""Benchmark decontamination by greedy string tiling.

1. Benchmark items are cut into seeds, runs of ``SEED`` words. A bit table of fixed size,
   made from all seeds, goes to the executors.
2. Each document's seeds are looked up in the table. Only runs of words in which every
   seed may occur in the benchmark go on, as word hashes; clean text goes no further.
3. Runs and items that share a seed meet in a join on the seed's hash. A pair goes on if
   its shared seeds cover enough of the item, which tiles can't exceed.
4. For each pair left, the longest common match of unmarked words is marked again and
   again (a running Karp-Rabin hash finds all matches of a length), down to seeds. Tiles
   don't overlap, and their order doesn't matter, so reordered passages count in full.
5. A document is contaminated if tiles cover 0.8 of an item's words or more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, freeing, result
from tickshard.llm.words import ALNUM, BASE, Words, mix, portions

SEED = 5
COVERAGE = 0.8
TABLE_BITS = 1 << 23
#: Copies of the items' words among which the documents that meet them are dealt.
DEALT = 16


def _bits_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each seed in the bit table."""
    low = (hashes & np.uint64(TABLE_BITS - 1)).astype(np.int64)
    high = ((hashes >> np.uint64(32)) & np.uint64(TABLE_BITS - 1)).astype(np.int64)
    return low, high


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's words and seeds as hashes; an item below the seed length is one seed."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for part in portions(texts):
            words = Words(texts[part], ALNUM)
            seeds, begins = words.shingles(SEED, whole_if_short=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id")[part.start : part.stop],
                    _lists(words.hashes(), words.first),
                    _lists(seeds, begins),
                ],
                names=["item_id", "words", "seeds"],
            )


def _lists(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(values.view(np.int64)))


def _seed_table(items: DataFrame) -> np.ndarray:
    """The bit table, as packed bytes; only tables of fixed size reach the driver."""
    bits = lambda seed: F.array(
        seed.bitwiseAND(TABLE_BITS - 1),
        F.shiftrightunsigned(seed, 32).bitwiseAND(TABLE_BITS - 1),
    )
    seeds = items.select(F.explode("seeds").alias("seed"))
    places = seeds.select(F.explode(bits(F.col("seed"))).alias("place"))
    at = places.select((F.col("place") + 1).alias("at"))
    rows = (
        at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    table = np.zeros(TABLE_BITS // 8 + 4096, dtype=np.uint8)
    for row in rows:
        own = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
        start = (row["bucket"] - 1) * 4096
        table[start : start + len(own)] = own
    return table


def _runs(shared, short: frozenset):
    """Runs of words of a document whose seeds may all be in the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        has = lambda at: (table[at >> 3] >> (at & 7)) & 1
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in portions(texts):
                words = Words(texts[part], ALNUM)
                word = words.hashes()
                rows, runs, seeds = [], [], []
                sizes = sorted({SEED, *short})
                for size in sizes:
                    own, begins = words.shingles(size)
                    low, high = _bits_of(own)
                    hit = np.flatnonzero(has(low) & has(high))
                    if not len(hit):
                        continue
                    text = np.searchsorted(begins, hit, side="right") - 1
                    new = np.ones(len(hit), dtype=bool)
                    new[1:] = (np.diff(hit) > 1) | (np.diff(text) > 0)
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(hit)) - 1
                    for a, b in zip(first.tolist(), last.tolist()):
                        t = int(text[a])
                        start = int(words.first[t] + hit[a] - begins[t])
                        stop = int(words.first[t] + hit[b] - begins[t]) + size
                        rows.append(part.start + t)
                        runs.append(word[start:stop].view(np.int64))
                        seeds.append(own[hit[a] : hit[b] + 1].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(runs, pa.list_(pa.int64())),
                        pa.array(seeds, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "run", "seeds"],
                )

    return run


def _matches(text: np.ndarray, pattern: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Places in both where the same *size* unmarked words stand: a running hash, then words.

    A marked word is 0 in either.
    """
    if len(text) < size or len(pattern) < size:
        return []
    most = max(len(text), len(pattern))
    power = np.full(most + 1, BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)

    def rolled(a: np.ndarray) -> np.ndarray:
        sums = np.concatenate(
            (np.zeros(1, dtype=np.uint64), np.cumsum(a * power[: len(a)], dtype=np.uint64))
        )
        n = len(a) - size + 1
        return (sums[size:] - sums[:n]) * power[most - np.arange(n)]

    free = lambda a: np.flatnonzero(np.convolve(a == 0, np.ones(size, int), "valid") == 0)
    at_text, at_pattern = free(text), free(pattern)
    h_text, h_pattern = rolled(text)[at_text], rolled(pattern)[at_pattern]
    order = np.argsort(h_text, kind="stable")
    low = np.searchsorted(h_text[order], h_pattern, side="left")
    high = np.searchsorted(h_text[order], h_pattern, side="right")
    found = []
    for p, a, b in zip(at_pattern.tolist(), low.tolist(), high.tolist()):
        for t in at_text[order[a:b]].tolist():
            if (text[t : t + size] == pattern[p : p + size]).all():
                found.append((t, p))
                break  # one place is enough: the words of the pattern are what is counted
    return found


def tile(text: np.ndarray, pattern: np.ndarray, least: int) -> int:
    """How many words of *pattern* greedy string tiling marks in *text*; runs are split by 0.

    The longest match is found by bisection over its length (a match of n words holds one
    of n - 1), all non-overlapping matches of that length are marked, then shorter ones.
    """
    text, pattern = text.copy(), pattern.copy()
    least = max(1, min(least, len(pattern)))
    size, marked = min(len(text), len(pattern)), 0
    while size >= least:
        low, high = least - 1, size
        while low < high:
            middle = (low + high + 1) // 2
            if _matches(text, pattern, middle):
                low = middle
            else:
                high = middle - 1
        size = low
        if size < least:
            break
        again = True
        while again:
            again = False
            for t, p in _matches(text, pattern, size):
                if text[t : t + size].all() and pattern[p : p + size].all():
                    text[t : t + size] = 0
                    pattern[p : p + size] = 0
                    marked += size
                    again = True
        size -= 1
    return marked


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marked = []
        for runs, words in zip(batch.column("runs"), batch.column("words")):
            pieces = []
            for run in runs.values:
                pieces += [run.values.to_numpy().view(np.uint64), np.zeros(1, dtype=np.uint64)]
            pattern = words.values.to_numpy().view(np.uint64)
            marked.append(tile(np.concatenate(pieces), pattern, SEED))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "item_id", "n_words")), pa.array(marked, pa.int64())],
            names=["doc_id", "item_id", "item_words", "tiled_words"],
        )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_words, tiled_words, coverage) of documents that hold an item.

    Words are runs of letters and digits with A-Z lowered. One row for each pair at a
    coverage of 0.8 or more; documents that hold no item have no row. An item of fewer
    words than a seed must occur whole. NULL or empty texts and items match nothing, NULL
    ids take no part; rows that repeat a doc_id count as parts of one document, repeated
    items (or item ids with several texts) as items of their own. Other columns are ignored.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        fields = "item_id bigint, words array<bigint>, seeds array<bigint>"
        texts = benchmark.where("item_id IS NOT NULL").select("item_id", "text")
        items = scratch.store(
            texts.mapInArrow(_item_words, fields)
            .where(F.size("words") > 0)
            .withColumn("item", F.xxhash64("item_id", "words"))
            .withColumn("n_words", F.size("words").cast("bigint"))
        )
        lengths = items.where(F.size("words") < SEED).groupBy("n_words").count().collect()
        short = frozenset(r["n_words"] for r in lengths)
        shared = spark.sparkContext.broadcast(_seed_table(items))
        known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
        runs = scratch.store(
            known.mapInArrow(
                freeing(_runs(shared, short)), "doc_id bigint, run array<bigint>, seeds array<bigint>"
            )
        )
        # a seed counts for as many words of its item as it can cover alone
        item_seeds = items.select(
            "item", "n_words", F.posexplode("seeds").alias("at", "seed")
        )
        doc_seeds = runs.select("doc_id", F.explode("seeds").alias("seed")).distinct()
        met = doc_seeds.join(item_seeds, "seed").groupBy("doc_id", "item", "n_words")
        shared_seeds = met.agg(F.count("*").alias("hits"))
        # tiles of c words hold c - (SEED - 1) seeds for each tile, so at least c / SEED
        enough = F.col("hits") * F.least(F.lit(SEED), "n_words") >= F.col("n_words") * COVERAGE
        pairs = scratch.store(shared_seeds.where(enough).select("doc_id", "item"))
        gathered = (
            runs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
            .groupBy("doc_id")
            .agg(F.collect_list("run").alias("runs"))
        )
        deal = F.pmod(F.xxhash64("doc_id"), F.lit(DEALT)).cast("int").alias("deal")
        copies = items.select("item", "item_id", "n_words", "words").distinct().withColumn(
            "deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
        )
        ready = pairs.join(gathered, "doc_id").withColumn("deal", deal).join(copies, ["item", "deal"])
        tiled = ready.select("doc_id", "item_id", "n_words", "runs", "words").mapInArrow(
            _tiled, "doc_id bigint, item_id bigint, item_words bigint, tiled_words bigint"
        )
        coverage = (F.col("tiled_words") / F.col("item_words")).alias("coverage")
        return result(tiled.select("*", coverage).where(F.col("coverage") >= COVERAGE))
