"""Ranked lexical search: term at a time, with a limit on accumulators that loses nothing.

Documents become a forward index of the asked terms in one pass over the texts; counts of
documents and terms come from all of it. A task then searches its part of the index in
blocks of bounded size. For each item it takes the terms rarest first. While the largest
sum that the terms left could give a document reaches the k-th best partial score, a
document met for the first time gets an accumulator. From there on it could not reach the
k-th any more, so no accumulators are made, and those that exist are brought to their exact
scores. The best of a block bound the next one. A task returns k documents for each item,
and these are ranked over all tasks.

Terms are compared as bytes, never by a hash. Items are searched in blocks of bounded size,
since their terms go to every task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, freeing, result
from tickshard.llm.words import ALNUM, Words, portions

#: Bytes of the terms of the items that are searched together, on average.
ITEM_BYTES = 16 << 20
#: Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 20


def terms(texts: Sequence[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, with repeats and in order, and how many each text has."""
    words = Words(texts, ALNUM)
    return words.slices(), words.counts()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, text in enumerate(batch.column("text").to_pylist()):
            found = pc.unique(terms([text])[0]).cast(pa.binary())
            item = batch.column("item_id").slice(i, 1).take(pa.array([0] * len(found), pa.int64()))
            yield pa.RecordBatch.from_arrays([item, found], names=["item_id", "term"])


def _indexed(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times): the asked terms of each document that has any term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(vocabulary.value, pa.large_binary())
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in portions(texts):
                found, counts = terms(texts[part])
                number = pc.index_in(found, value_set=asked)
                known = number.is_valid().to_numpy(zero_copy_only=False)
                own = np.repeat(np.arange(len(counts)), counts)[known]
                term = number.drop_null().to_numpy().astype(np.int64)
                pairs, times = np.unique(own * max(1, len(asked)) + term, return_counts=True)
                own, term = np.divmod(pairs, max(1, len(asked)))
                begins = pa.array(np.searchsorted(own, np.arange(len(counts) + 1)).astype(np.int32))
                rows = pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[part.start : part.stop],
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(begins, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(begins, pa.array(times.astype(np.int64))),
                    ],
                    names=["doc_id", "n", "terms", "times"],
                )
                yield rows.filter(pa.array(counts > 0))

    fields = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(freeing(run), fields)


class Block:
    """The postings of a few documents, term by term."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, term, times, spread: tuple[int, int], size: int):
        documents, length = spread
        if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
            raise OverflowError("lengths of documents do not fit 64 bits")
        m = 10 + (90 * n * documents) // max(1, length)
        own = np.repeat(np.arange(len(n)), sizes)
        part = (1_000_000_000 * times) // (1000 * times + 8 * m[own])
        order = np.argsort(term, kind="stable")
        self.docs, self.part = own[order], part[order]
        self.begins = np.searchsorted(term[order], np.arange(size + 1))
        self.most = np.zeros(size, dtype=np.int64)
        np.maximum.at(self.most, term, part)
        self.size = len(n)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.begins[term], self.begins[term + 1])
        return self.docs[at], self.part[at]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def accumulate(block: Block, asked: np.ndarray, weight: np.ndarray, k: int, best: np.ndarray):
    """Exact scores of all documents of *block* that can be among the k best for an item.

    *asked* are its terms, rarest first, *best* the scores of the best documents known. Others
    may have a score that is too small, or none; a document at the k-th best score is kept.
    """
    scores = np.zeros(block.size, dtype=np.int64)
    left = np.cumsum((weight[asked] * block.most[asked])[::-1])[::-1]  # by this and later terms
    known = _kth(best, k)
    open_ = True
    for i, term in enumerate(asked):
        docs, part = block.postings(term)
        if open_ and left[i] < known:
            open_ = False
        elif open_ and i and left[i] < scores.max():
            partial = scores[scores > 0]
            open_ = left[i] >= max(known, _kth(np.concatenate([best, partial]), k))
        if open_:
            scores[docs] += weight[term] * part
            continue
        survivors = np.flatnonzero(scores)
        if not len(survivors):
            break
        if len(survivors) * 8 < len(docs):
            at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            met = docs[at] == survivors
            scores[survivors[met]] += weight[term] * part[at[met]]
        else:
            met = scores[docs] > 0
            scores[docs[met]] += weight[term] * part[met]
    return scores


class Best:
    """The k best documents of one item so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)
        self.blank = np.zeros(0, dtype=bool)  # NULL ids, which come last

    def add(self, scores: np.ndarray, ids: np.ndarray, blank: np.ndarray) -> None:
        least = max(1, _kth(self.scores, self.k))
        at = np.flatnonzero(scores >= least)
        if len(at) > self.k:
            at = at[scores[at] >= _kth(scores[at], self.k)]
        scores = np.concatenate([self.scores, scores[at]])
        ids, blank = np.concatenate([self.ids, ids[at]]), np.concatenate([self.blank, blank[at]])
        order = np.lexsort((ids, blank, -scores))[: self.k]
        self.scores, self.ids, self.blank = scores[order], ids[order], blank[order]


def _blocks(batches: Iterator[pa.RecordBatch], spread: tuple[int, int], size: int):
    """Blocks of postings with the ids of their documents."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0

    def made():
        table = pa.Table.from_batches(held).combine_chunks()
        flat = [table.column(c).combine_chunks().flatten().to_numpy() for c in ("terms", "times")]
        sizes = pc.list_value_length(table.column("terms")).to_numpy().astype(np.int64)
        ids = table.column("doc_id")
        known = pc.fill_null(ids, 0).to_numpy()
        block = Block(table.column("n").to_numpy(), sizes, *flat, spread, size)
        return block, known, ids.is_null().to_numpy()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        docs += batch.num_rows
        postings += len(batch.column("terms").flatten())
        if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
            yield made()
            held, docs, postings = [], 0, 0
    if held:
        yield made()


def _searched(index: DataFrame, plan, spread: tuple[int, int], k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = plan.value
        best = [Best(k) for _ in items]
        for block, ids, blank in _blocks(batches, spread, len(weight)):
            for own, (_, asked) in zip(best, items):
                own.add(accumulate(block, asked, weight, k, own.scores), ids, blank)
        for own, (item, _) in zip(best, items):
            if len(own.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(own.scores), pa.int64()),
                        pa.array(own.ids, pa.int64(), mask=own.blank),
                        pa.array(own.scores),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    return index.mapInArrow(freeing(run), "item_id bigint, doc_id bigint, score bigint")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the *k* documents with the highest scores for each item.

    *docs*: doc_id, text; *items*: item_id, text. Terms are runs of ASCII letters and digits
    and of all characters beyond ASCII, with A-Z lowered; NULL texts have none. The score
    sums ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over the item's terms, where
    ``m = 10 + (90 * n * N) div L``, in whole numbers, and ``w`` is the floor of
    ``1000 * ln((2 * N + 2) / (2 * df + 1))``; N documents have a term, L terms are in them,
    n in this one. Only scores above 0 are ranked, equal ones by id, NULL ids last.

    Rows that repeat a doc_id are documents of their own; rows that repeat an item_id, NULL
    included, are one item with the terms of all. Items without terms, empty tables and items
    that no document meets give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        asked = scratch.store(
            items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
            .mapInArrow(_item_terms, "item_id bigint, term binary")
            .distinct()
        )
        total = asked.agg(F.sum(F.length("term") + 16)).first()[0] or 0
        turns = max(1, -(-total // ITEM_BYTES))
        turn = F.pmod(F.xxhash64("item_id"), F.lit(turns))
        found = []
        for number in range(turns):
            own = asked.where(turn == number).collect()
            vocabulary = sorted({bytes(r["term"]) for r in own})
            shared = spark.sparkContext.broadcast(vocabulary)
            index = scratch.store(_indexed(docs, shared))
            spread = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
            counts = index.select(F.explode("terms").alias("term")).groupBy("term").count()
            df = dict(counts.collect())  # at most one row for each asked term
            weight = np.array(
                [
                    math.floor(1000 * math.log((2 * spread[0] + 2) / (2 * df.get(t, 0) + 1)))
                    for t in range(len(vocabulary))
                ],
                dtype=np.int64,
            )
            number_of = {term: t for t, term in enumerate(vocabulary)}
            by_item: dict[int | None, list[int]] = {}
            for r in own:
                t = number_of[bytes(r["term"])]
                if t in df:
                    by_item.setdefault(r["item_id"], []).append(t)
            plan = [
                (item, np.array(sorted(own_terms, key=lambda t: (df[t], t)), dtype=np.int64))
                for item, own_terms in by_item.items()
            ]
            plan = spark.sparkContext.broadcast((plan, weight))
            found.append(scratch.store(_searched(index, plan, tuple(spread), k)))
            scratch.drop(index)
            shared.unpersist()
            plan.unpersist()
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return result(ranked.select("item_id", "rank", "doc_id", "score"))
