"""Short codes of vectors: product quantisation with norm-of-sum bounds.

Vectors become whole numbers and fall into ``PARTS`` equal parts; each part position has a
codebook of ``ENTRIES`` entries. A round assigns every part to its nearest entry and moves
the entries. All codebooks of the past are kept (their size is fixed by the parameters),
and each part of a vector carries two bounds with the round they were made in: the distance
to its own entry and the distance to the nearest other one. In a later round an entry has
moved by the true distance between its two positions, the norm of the sum of its moves,
which is at most the sum of the norms of its moves. So:

1. own distance then + net move of the own entry < other distance then - largest net move
   of any other entry: the code stays, nothing is computed;
2. otherwise the distance to the own entry is computed anew and tried in the same test;
3. only parts that fail both are compared with all entries, and get bounds of this round.

Both tests are strict and leave room for rounding, so a part that passes has one nearest
entry and ties are always settled by a whole scan: codes are those of the plain method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, result

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Labels with at least one of so many rows are joined by a broadcast: there are no more of them.
HOT_SHARE = 256
#: Parts that are compared with all entries at once.
SCAN = 8192
#: Room for rounding in the tests of bounds: of a relative error of square roots.
SLACK = 1e-9

_MOST = np.iinfo(np.int64).max
_BOUNDS = ("near", "other", "near_at", "other_at")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vector is whole, with their components as whole numbers."""
    for batch in batches:
        column = batch.column("embedding")
        offsets = column.offsets.to_numpy().astype(np.int64)
        low = offsets[0]
        flat = column.values.slice(low, offsets[-1] - low)
        values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL becomes NaN
        offsets = offsets - low
        bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
        good = bad[offsets[1:]] == bad[offsets[:-1]]
        good &= column.is_valid().to_numpy(zero_copy_only=False)
        scaled = np.floor(values * SCALE)
        keep = np.repeat(good, np.diff(offsets))
        if (np.abs(scaled[keep]) >= 1 << 62).any():
            raise OverflowError("a component is too large for 64 bits")
        sizes = np.diff(offsets)[good]
        begins = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        rows = batch.filter(pa.array(good))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("vec_id"),
                rows.column("label"),
                pa.ListArray.from_arrays(pa.array(begins), pa.array(scaled[keep].astype(np.int64))),
            ],
            names=["vec_id", "label", "x"],
        )


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis, in the narrowest arithmetic that holds them.

    A distance that does not fit is the largest number.
    """
    most = int(max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)))
    if 4 * most * most * x.shape[-1] < 1 << 63:
        difference = x - y
        return np.einsum("...i,...i->...", difference, difference)
    wide = ((x.astype(object) - y.astype(object)) ** 2).sum(axis=-1)
    return np.minimum(wide, _MOST).astype(np.int64)


def _fitting(squares: np.ndarray) -> np.ndarray:
    if squares.size and squares.max() == _MOST:
        raise OverflowError("a squared distance does not fit 64 bits")
    return squares


def _scan(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For parts *x* of one position: nearest entry, its squared distance, that of the next one."""
    code = np.zeros(len(x), dtype=np.int64)
    near = np.zeros(len(x), dtype=np.int64)
    other = np.full(len(x), _MOST)
    for start in range(0, len(x), SCAN):
        here = slice(start, start + SCAN)
        squares = _squares(x[here, None, :], book[None, :, :])
        code[here] = squares.argmin(axis=1)  # the first one of equals
        row = np.arange(len(squares))
        near[here] = squares[row, code[here]]
        if len(book) > 1:
            squares[row, code[here]] = _MOST
            other[here] = squares.min(axis=1)
    return code, _fitting(near), other


class Bounds:
    """Codes and bounds of the parts of a few vectors, as arrays of (vectors, parts).

    ``near`` is the squared distance to the own entry of round ``near_at``; ``other`` is that
    to the nearest other entry of round ``other_at``.
    """

    def __init__(self, code: np.ndarray, bounds: dict[str, np.ndarray]):
        self.code = code
        self.near, self.other = bounds["near"], bounds["other"]
        self.near_at, self.other_at = bounds["near_at"], bounds["other_at"]
        #: Parts that were compared with all entries.
        self.scanned = 0

    @classmethod
    def none(cls, vectors: int, parts: int) -> Bounds:
        blank = {n: np.zeros((vectors, parts), dtype=np.int64) for n in _BOUNDS[:2]}
        blank |= {n: np.full((vectors, parts), -1, dtype=np.int8) for n in _BOUNDS[2:]}
        return cls(np.zeros((vectors, parts), dtype=np.int64), blank)

    def assign(self, x: np.ndarray, history: np.ndarray) -> None:
        """Bring codes up to the last codebook of *history* (round, part, entry, component)."""
        now = len(history) - 1
        for p in range(x.shape[1]):
            books = history[:, p]
            own = x[:, p]
            open_ = np.ones(len(own), dtype=bool)
            if now:
                moved = np.sqrt(
                    ((books.astype(np.float64) - books[now].astype(np.float64)) ** 2).sum(axis=2)
                )
                room = self._room(p, moved)
                upper = np.sqrt(self.near[:, p].astype(np.float64))
                upper += moved[self.near_at[:, p], self.code[:, p]]
                open_ = upper * (1 + SLACK) >= room
                again = np.flatnonzero(open_)
                exact = _squares(own[again], books[now][self.code[again, p]])
                self.near[again, p] = exact
                self.near_at[again, p] = now
                open_[again] = np.sqrt(exact.astype(np.float64)) * (1 + SLACK) >= room[again]
            rest = np.flatnonzero(open_)
            self.scanned += len(rest)
            found = _scan(own[rest], books[now])
            self.code[rest, p], self.near[rest, p], self.other[rest, p] = found
            self.near_at[rest, p] = self.other_at[rest, p] = now

    def _room(self, p: int, moved: np.ndarray) -> np.ndarray:
        """At least this far away is every entry but the own one."""
        code, since = self.code[:, p], self.other_at[:, p]
        room = np.sqrt(self.other[:, p].astype(np.float64)) * (1 - SLACK)
        order = np.argsort(moved, axis=1)
        most = order[:, -1]
        furthest = moved[np.arange(len(moved)), most]
        if moved.shape[1] == 1:
            return np.full(len(room), np.inf)
        second = moved[np.arange(len(moved)), order[:, -2]]
        return room - np.where(code == most[since], second[since], furthest[since]) * (1 + SLACK)

    def finish(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        """Exact squared distances to the own entries of *book*."""
        own = [_squares(x[:, p], book[p][self.code[:, p]]) for p in range(x.shape[1])]
        return _fitting(np.stack(own, axis=1))


def _parts(batch: pa.RecordBatch, width: int) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy()
    return flat.reshape(batch.num_rows, PARTS, width // PARTS)


def _grid(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(batch.num_rows, PARTS).copy()


def _lists(grid: np.ndarray) -> pa.Array:
    begins = np.arange(len(grid) + 1, dtype=np.int32) * grid.shape[1]
    return pa.ListArray.from_arrays(pa.array(begins), pa.array(grid.ravel()))


def _assigned(rows: DataFrame, history, width: int, first: bool) -> DataFrame:
    """*rows* with codes for the last codebook, and with the bounds for later rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _parts(batch, width)
            if first:
                state = Bounds.none(batch.num_rows, PARTS)
            else:
                code = _grid(batch, "code").astype(np.int64)
                state = Bounds(code, {n: _grid(batch, n) for n in _BOUNDS})
            state.assign(x, history.value)
            columns = {n: batch.column(n) for n in ("vec_id", "label", "x")}
            columns["code"] = _lists(state.code.astype(np.int8))
            columns |= {n: _lists(getattr(state, n)) for n in _BOUNDS}
            yield pa.RecordBatch.from_pydict(columns)

    fields = f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, "
    fields += "x array<bigint>, code array<tinyint>, near array<bigint>, other array<bigint>, "
    return rows.mapInArrow(run, fields + "near_at array<tinyint>, other_at array<tinyint>")


def _moved(assigned: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook whose entries are the floored means of their parts; others stay.

    A task adds up its own rows, so one row for each component of a codebook leaves it.
    """
    parts, entries, width = book.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        counts = np.zeros(parts * entries, dtype=np.int64)
        largest = 0
        for batch in batches:
            x = _parts(batch, parts * width)
            cell = _grid(batch, "code") + np.arange(parts) * entries
            if x.size:
                largest += int(np.abs(x).max()) * len(x)
            if largest >= 1 << 62:
                raise OverflowError("a sum of components does not fit 64 bits")
            np.add.at(sums, cell.ravel(), x.reshape(cell.size, width))
            counts += np.bincount(cell.ravel(), minlength=len(counts))
        used = np.flatnonzero(counts)
        if len(used):
            places = (used[:, None] * width + np.arange(width)).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(places.astype(np.int64)),
                    pa.array(sums[used].ravel()),
                    pa.array(np.repeat(counts[used], width)),
                ],
                names=["place", "total", "n"],
            )

    added = assigned.select("x", "code").mapInArrow(run, "place bigint, total bigint, n bigint")
    sums = added.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = book.copy().ravel()
    for place, total, n in sums.collect():  # at most the components of a codebook
        moved[place] = total // n
    return moved.reshape(book.shape)


def _started(rows: DataFrame, width: int) -> np.ndarray:
    """The parts of the rows with the smallest ids, as entries in ascending order."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    first = rows.orderBy(*order).limit(ENTRIES).select("x").collect()
    x = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), PARTS, width // PARTS)
    return np.ascontiguousarray(x.transpose(1, 0, 2))


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """*coded* with the sum of errors over rows of an equal label, NULLs together.

    Sums are made before rows meet them. At most HOT_SHARE labels hold one HOT_SHARE-th of
    all rows each; these are broadcast, so no task gets the rows of a frequent label.
    """
    hot, sums = "__hot", "label_error"
    totals = coded.groupBy("label").agg(F.sum("error").alias(sums), F.count("*").alias("__n"))
    totals = totals.withColumn(hot, F.col("__n") * HOT_SHARE >= F.lit(coded.count())).drop("__n")
    known = totals.select(F.col("label").alias("__label"), sums, hot)
    same = F.col("label").eqNullSafe(F.col("__label"))
    near = coded.join(F.broadcast(known.where(hot)), same, "left")
    done = near.where(F.col(hot).isNotNull()).select(*coded.columns, sums)
    rest = near.where(F.col(hot).isNull()).select(*coded.columns)
    rare = rest.join(known.where(~F.col(hot)), same).select(*coded.columns, sums)
    return done.unionByName(rare)


def compress(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256, label) for every whole vector.

    *vectors*: vec_id, embedding, label. Rows whose vector is NULL or holds NULL, NaN or an
    infinity take no part. A component becomes ``floor(256 * x)``. Entries start as the parts
    of the ENTRIES smallest ids (rows that repeat an id are vectors of their own, in order of
    their components; NULL ids come last; fewer rows make fewer entries) and move ROUNDS
    times. ``code`` has two hex digits for each part, ``error`` is the squared distance to
    the coded vector, ``label_error`` its sum over the rows of an equal label. Vectors must
    have one length that the parts divide, else it is a ``ValueError``; numbers that do not
    fit 64 bits are an ``OverflowError``. Other columns are ignored; an empty table has no
    codes.
    """
    spark = vectors.sparkSession
    schema = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
    kind = vectors.schema["label"].dataType.simpleString()
    with Scratch(spark) as scratch:
        fields = f"vec_id bigint, label {kind}, x array<bigint>"
        read = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
        rows = scratch.store(read.mapInArrow(_whole, fields))
        least, width = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
        if width is None:
            return spark.createDataFrame([], f"{schema}, label {kind}")
        if least != width or width % PARTS:
            raise ValueError(f"vectors need one length that {PARTS} divides: {least} to {width}")
        history = _started(rows, width)[None]
        state = rows
        for number in range(ROUNDS + 1):
            shared = spark.sparkContext.broadcast(history)
            last, state = state, scratch.store(_assigned(state, shared, width, number == 0))
            scratch.drop(last)
            shared.unpersist()
            if number < ROUNDS:
                history = np.concatenate([history, _moved(state, history[-1])[None]])
        book = history[-1]
        final = spark.sparkContext.broadcast(book)

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code = _grid(batch, "code")
                blank = {n: np.zeros(0) for n in _BOUNDS}
                squares = Bounds(code, blank).finish(_parts(batch, width), final.value)
                total = squares.sum(axis=1)
                if (squares.astype(np.float64).sum(axis=1) >= 2.0**63).any():
                    raise OverflowError("an error does not fit 64 bits")
                digits = code.astype(np.uint8).tobytes().hex()
                step = 2 * PARTS
                codes = [digits[i * step : (i + 1) * step] for i in range(len(code))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(codes, pa.string()), pa.array(total), batch.column("label")],
                    names=["vec_id", "code", "error", "label"],
                )

        fields = f"vec_id bigint, code string, error bigint, label {kind}"
        coded = scratch.store(state.select("vec_id", "label", "x", "code").mapInArrow(finish, fields))
        digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
        found = _with_label_errors(coded).withColumn("codebooks_sha256", F.lit(digest))
        return result(found.select("vec_id", "code", "error", "label_error", "codebooks_sha256", "label"))
