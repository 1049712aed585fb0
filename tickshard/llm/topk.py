"""Exact top-k by inner product: a pivot-distance index searched in sorted annuli.

Vectors become integers. One more component, sqrt(M - |x|^2) with M the largest squared
norm, gives all of them one length and queries get 0 there, so a larger inner product is a
smaller distance: |q - x|^2 = |q|^2 + M - 2 q.x. Pivots are centres of a bounded sample;
every vector is keyed by its nearest pivot and its distance from it, in rings around the
pivot. By the triangle inequality no vector of a ring [lo, hi] is nearer to a query at
distance d from the pivot than max(d - hi, lo - d, 0).

A query first searches its nearest rings until they hold k vectors. Its k-th score then
bounds the rest: only rings that could hold a better or equal score are searched, all of
them, so results are exact and the index only decides what is read. Rings and queries meet
in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, result

PIVOTS = 32
RINGS = 4
#: Vectors the pivots and ring widths are fitted on, those with the smallest hash of the id.
SAMPLE = 2048
#: Vectors of a ring, and queries, that meet in one task.
RING_BLOCK, QUERY_BLOCK = 4096, 2048
SCALE = 256
#: Whole components from here on are an error: no score of them with themselves fits a long.
LARGEST = 1 << 62


def _quantized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, values, norms = [], [], []
        for i, row in enumerate(batch.column("embedding")):
            row = row.as_py()
            if row is None or None in row:
                continue
            x = np.floor(np.array(row, dtype=np.float64) * SCALE)
            if np.isfinite(np.array(row, dtype=np.float64)).all():
                if (np.abs(x) >= LARGEST).any():
                    raise OverflowError("a component is too large for scores in 64 bits")
                rows.append(i)
                values.append(x.astype(np.int64))
                norms.append(float((x**2).sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id").take(pa.array(rows, pa.int64())),
                pa.array(values, pa.list_(pa.int64())),
                pa.array(norms, pa.float64()),
            ],
            names=["vec_id", "x", "norm"],
        )


def _matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows of integers; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, flat = column.offsets.to_numpy(), column.flatten().to_numpy(zero_copy_only=False)
    offsets = offsets - offsets[0]
    found = np.zeros((len(column), width), dtype=kind)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(column)), sizes)
    found[row, np.arange(len(flat)) - np.repeat(offsets[:-1], sizes)] = flat
    return found


def _lengthened(x: np.ndarray, most: int) -> np.ndarray:
    """With the component that gives all vectors one length."""
    rest = np.sqrt(np.maximum(most - (x**2).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def _pivots(sample: np.ndarray) -> np.ndarray:
    """Centres of the sample: spread-out starts, then a few rounds of moving to the mean."""
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    pivots = sample[chosen]
    for _ in range(5):
        own = _distances(sample, pivots).argmin(axis=1)
        pivots = np.stack(
            [sample[own == p].mean(axis=0) if (own == p).any() else pivots[p] for p in range(len(pivots))]
        )
    return pivots


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of rows of whole numbers, in the narrowest arithmetic that holds them."""
    norms = [np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max()) for m in (q, x)]
    most = norms[0] * norms[1]  # of a product, and of any part of its sum
    if most < 1 << 52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 1 << 62:
        return q @ x.T
    wide = q.astype(object) @ x.astype(object).T
    if max(abs(v) for v in wide.flat) >= 1 << 63:
        raise OverflowError("a score does not fit 64 bits")
    return wide.astype(np.int64)


def _searcher(width: int, k: int):
    def run(left, right):
        """Each query's k best in a block of a ring."""
        ids, own = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
        found = []
        if len(ids) and len(own):
            x = _matrix(left.column("x"), width, np.int64)
            for start in range(0, len(own), 256):
                q = _matrix(right.column("q").slice(start, 256), width, np.int64)
                for i, row in enumerate(_scores(q, x)):
                    query = own[start + i]
                    others = np.flatnonzero(ids != query)
                    for at in others[_best(row[others], ids[others], k)]:
                        found.append((query, ids[at], int(row[at])))
        columns = list(zip(*found)) if found else [(), (), ()]
        return pa.table(
            {n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)}
        )

    return run


def exact_top_k(vectors: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of every query row.

    *vectors*: vec_id, embedding. Each component becomes ``floor(256 * x)``; the score is
    the inner product of these, ties go to the smaller id. Rows that are NULL, hold NULL,
    NaN or an infinity, or have a NULL id take no part; a score that does not fit a long is an
    error. A shorter vector counts as if it ended in zeros. A query's own id is no candidate; rows that
    repeat an id are candidates each, and one query with the first of their vectors. With fewer
    candidates all are returned. Other columns are ignored.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        fields = "vec_id bigint, x array<bigint>, norm double"
        known = vectors.where("vec_id IS NOT NULL").select("vec_id", "embedding")
        rows = scratch.store(known.mapInArrow(_quantized, fields))
        most, width = rows.agg(F.max("norm"), F.max(F.size("x"))).first()
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
        if not sample:
            return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
        padded = np.zeros((len(sample), width))
        for i, r in enumerate(sample):
            padded[i, : len(r["x"])] = r["x"]
        sample = _lengthened(padded, most)
        pivots = _pivots(sample)
        nearest = _distances(sample, pivots).min(axis=1)
        cuts = np.quantile(nearest, np.arange(1, RINGS) / RINGS)
        shared = spark.sparkContext.broadcast((pivots, cuts))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots, cuts = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                distance = _distances(_lengthened(_matrix(batch.column("x"), width), most), pivots)
                own = distance.argmin(axis=1)
                near = distance[np.arange(len(own)), own]
                ring = own * RINGS + np.searchsorted(cuts, near, side="right")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        batch.column("x"),
                        pa.array(ring.astype(np.int32)),
                        pa.array(near),
                    ],
                    names=["vec_id", "x", "ring", "near"],
                )

        placed = scratch.store(
            rows.mapInArrow(place, "vec_id bigint, x array<bigint>, ring int, near double")
        )
        # at most PIVOTS * RINGS rows
        stats = placed.groupBy("ring").agg(
            F.count("*").alias("n"), F.min("near").alias("lo"), F.max("near").alias("hi")
        )
        rings = sorted((r["ring"], r["n"], r["lo"], r["hi"]) for r in stats.collect())
        blocks = {ring: -(-n // RING_BLOCK) for ring, n, _, _ in rings}
        in_ring = F.create_map(*[F.lit(v) for item in blocks.items() for v in item])
        block = F.pmod(F.xxhash64("vec_id"), F.try_element_at(in_ring, F.col("ring"))).cast("int")
        blocked = placed.select("vec_id", "x", "ring", block.alias("block"))
        queries = rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("q"))
        queries = scratch.store(queries.withColumnRenamed("vec_id", "query_id"))
        query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
        table = spark.sparkContext.broadcast(rings)

        def routed(later: bool):
            """(query, ring): the nearest rings that hold k others, or the rest that could matter."""

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                pivots, _ = shared.value
                number, n, lo, hi = (np.array(c) for c in zip(*table.value))
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    q = _matrix(batch.column("q"), width)
                    square = (q**2).sum(axis=1)
                    q = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
                    d = _distances(q, pivots)[:, number // RINGS]
                    bound = np.maximum(np.maximum(d - hi, lo - d), 0.0)
                    order = np.argsort(bound, axis=1, kind="stable")
                    row, ring = [], []
                    for i in range(len(q)):
                        enough = int(np.searchsorted(np.cumsum(n[order[i]]), k + 1)) + 1
                        wanted = order[i][:enough]
                        if later:
                            least = batch.column("least")[i].as_py()
                            wanted = order[i][enough:]
                            if least is not None:
                                # room for the rounding of distances, by the size of their parts
                                top = (square[i] + most - bound[i][wanted] ** 2) / 2
                                wanted = wanted[top + (square[i] + most) * 1e-6 + 1e-3 >= least]
                        row += [i] * len(wanted)
                        ring += number[wanted].tolist()
                    at = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("query_id").take(at),
                            batch.column("q").take(at),
                            pa.array(ring, pa.int32()),
                        ],
                        names=["query_id", "q", "ring"],
                    )

            return run

        def search(asked: DataFrame) -> DataFrame:
            every = F.sequence(F.lit(0), F.try_element_at(in_ring, F.col("ring")) - 1)
            own = F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("turn")
            asked = asked.select("query_id", "q", "ring", F.explode(every).alias("block"), own)
            turns = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("turn")
            cells = ["ring", "block", "turn"]
            return (
                blocked.select("*", turns)
                .groupBy(*cells)
                .cogroup(asked.groupBy(*cells))
                .applyInArrow(_searcher(width, k), "query_id bigint, vec_id bigint, score bigint")
            )

        fields = "query_id bigint, q array<bigint>, ring int"
        first = scratch.store(search(queries.mapInArrow(routed(False), fields)))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        kth = (
            first.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") == k)
            .select("query_id", F.col("score").alias("least"))
        )
        asked = queries.join(kth, "query_id", "left")
        rest = search(asked.mapInArrow(routed(True), fields))
        ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order))
        return result(ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
