"""Near-duplicate documents: an inverted join over the coordinates of MinHash signatures.

1. Each text becomes its set of word shingles, and the set a signature of ``COORDINATES``
   minima. Documents with one set are one class from here on, whatever their number.
2. Two sets with similarity 0.8 agree in ``MATCHES`` coordinates but for one pair in about
   100,000, so they share one of the ``COORDINATES - MATCHES + 1`` rarest coordinate
   values of either: only this prefix is posted. A sketch of fixed size, counted over all
   signatures, says which values are rare.
3. The members of a short posting list are paired by a join on the list; those of a long
   list are paired with one hub, its most typical member. Collisions of a pair are counted
   over the whole signatures, and pairs at ``MATCHES`` or more are confirmed on full sets.
4. Lists whose members are all connected by then are skipped. What is left of the long
   ones goes to tasks by pairs of blocks of members; a task confirms its pairs on full
   sets by one matrix product and returns a spanning forest, never the pairs.

Links that are found join classes; class labels are the smallest ``doc_id`` reachable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickshard.llm.components import components
from tickshard.llm.scratch import Scratch, freeing, result
from tickshard.llm.words import SPACED, Words, mix, portions, sets_of

COORDINATES = 48
MATCHES = 26
PREFIX = COORDINATES - MATCHES + 1
SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 14
#: Lists up to this many members are paired by a join.
SHORT_LIST = 32
#: Members of a long list that one side of a task holds, and shingles of their sets, on average.
BLOCK = 512
BLOCK_ITEMS = 1 << 20
#: Bits of the filter that keeps texts without a candidate pair out of a shuffle.
FILTER_BITS = 1 << 24

_RANDOM = np.random.default_rng(20240117)
_FACTORS = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)


def signatures(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of minima for each (non-empty) set."""
    minima = np.empty((len(begins) - 1, COORDINATES), dtype=np.uint32)
    for k in range(COORDINATES):
        values = (((hashes ^ _MASKS[k]) * _FACTORS[k]) >> np.uint64(32)).astype(np.uint32)
        minima[:, k] = np.minimum.reduceat(values, begins[:-1])
    return minima


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)))
    return (total[begins[1:]] - total[begins[:-1]]).view(np.int64)


def _coordinate_values(batch: pa.RecordBatch) -> np.ndarray:
    """Signature rows as 64-bit values in which the coordinate has its part."""
    flat = np.frombuffer(b"".join(batch.column("sig").to_pylist()), dtype=np.uint32)
    rows = flat.reshape(-1, COORDINATES).astype(np.uint64)
    return mix((rows << np.uint64(6)) | np.arange(COORDINATES, dtype=np.uint64))


def _fingerprint(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in portions(texts):
                sets = sets_of(*Words(texts[part], SPACED).shingles(shingle, whole_if_short=True))
                hashes, begins = sets
                sizes = np.diff(begins)
                full = np.flatnonzero(sizes)
                sig = [None] * len(sizes)
                kept = np.concatenate((begins[full], begins[-1:]))
                if len(full):
                    for i, row in zip(full, signatures(hashes, kept)):
                        sig[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[part.start : part.stop],
                        pa.array(sizes.astype(np.int64)),
                        pa.array(_sums(mix(hashes), begins)),
                        pa.array(_sums(mix(hashes ^ _MASKS[0]), begins)),
                        pa.array(sig, pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "key_a", "key_b", "sig"],
                )

    return run


def _count_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for batch in batches:
        cells = (_coordinate_values(batch) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
        counts += np.bincount(cells.ravel(), minlength=len(counts))
    for block in range(len(counts) // SKETCH_BLOCK):
        own = counts[block * SKETCH_BLOCK : (block + 1) * SKETCH_BLOCK]
        raw = np.minimum(own, 65535).astype(np.uint16).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([raw], pa.binary())], names=["block", "n"]
        )


def _add_counts(left):
    """The sum of a block's counts, which stop at 65,535: values beyond are all common."""
    total = np.zeros(SKETCH_BLOCK, dtype=np.int64)
    for raw in left.column("n"):
        total += np.frombuffer(raw.as_py(), dtype=np.uint16)
    raw = np.minimum(total, 65535).astype(np.uint16).tobytes()
    return pa.table({"block": left.column("block")[:1], "n": pa.array([raw], pa.binary())})


def _sketch(reps: DataFrame) -> np.ndarray:
    """How often a value with this hash occurs, at most; two bytes for each of its cells."""
    fields = "block int, n binary"
    counted = reps.select("sig").mapInArrow(_count_values, fields)
    table = np.zeros(1 << SKETCH_BITS, dtype=np.uint16)
    for row in counted.groupBy("block").applyInArrow(_add_counts, fields).collect():
        start = row["block"] * SKETCH_BLOCK
        table[start : start + SKETCH_BLOCK] = np.frombuffer(row["n"], dtype=np.uint16)
    return table


def _post(sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sketch.value
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _coordinate_values(batch)
            counts = table[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            rarest = np.lexsort((values, counts), axis=1)[:, :PREFIX]
            chosen = np.take_along_axis(values, rarest, axis=1)
            shared = np.take_along_axis(counts, rarest, axis=1) > 1
            typical = (np.log2(counts.astype(np.float64)).mean(axis=1) * 1e6).astype(np.int64)
            row, place = np.nonzero(shared)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chosen[row, place].view(np.int64)),
                    batch.column("rep").take(at),
                    batch.column("n_shingles").take(at),
                    pa.array(typical[row]),
                ],
                names=["value", "rep", "n", "typical"],
            )

    return run


def _close(a: str, b: str):
    """Set sizes that a pair with similarity 0.8 can have."""
    return (F.col(a) * 100 >= F.col(b) * 80) & (F.col(b) * 100 >= F.col(a) * 80)


def _collisions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough coordinates."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32)
            for c in ("sig_a", "sig_b")
        )
        agree = (a == b).reshape(-1, COORDINATES).sum(axis=1) >= MATCHES
        yield batch.filter(pa.array(agree)).select(["a", "b"])


def _wanted_filter(ids: DataFrame) -> np.ndarray:
    """A fixed-size bit table of the ids in *ids*; it may say yes to others, never no to these."""
    cells = ids.select((F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS)) + 1).alias("at"))
    tables = (
        cells.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS + 32768, dtype=np.uint8)
    for row in tables:
        own = np.unpackbits(np.frombuffer(bytes(row["bits"]), dtype=np.uint8), bitorder="little")
        start = (row["bucket"] - 1) * 32768
        bits[start : start + len(own)] = own
    return np.packbits(bits)


def _full_sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(rep, items): the full sets of the documents in *ids*, made anew from their texts.

    An id that comes with several texts has all their sets.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_wanted_filter(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            wanted = (bits.value[cell >> 3] >> (7 - (cell & 7))) & 1
            batch = batch.filter(pa.array(wanted.astype(bool)))
            texts = batch.column("text").to_pylist()
            for part in portions(texts):
                sets = sets_of(*Words(texts[part], SPACED).shingles(shingle, whole_if_short=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rep")[part.start : part.stop],
                        pa.array(_sums(mix(sets[0]), sets[1])),
                        pa.ListArray.from_arrays(
                            pa.array(sets[1].astype(np.int32)), pa.array(sets[0].view(np.int64))
                        ),
                    ],
                    names=["rep", "key", "items"],
                )

    cell = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("cell")
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text", cell)
    sets = rows.mapInArrow(freeing(run), "rep bigint, key bigint, items array<bigint>")
    sets = sets.join(ids, "rep", "left_semi").groupBy("rep", "key")
    return sets.agg(F.first("items").alias("items")).drop("key")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets have a similarity of 0.8 or more."""
    side = lambda end: sets.select(F.col("rep").alias(end), F.col("items").alias(f"set_{end}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    union = F.size("set_a") + F.size("set_b") - shared
    return both.where(shared * 100 >= union * 80).select("a", "b")


def _forest(left):
    """Links between the classes of two blocks of a list's members, as a spanning forest."""
    left = left.combine_chunks()
    comp = left.column("comp").to_numpy()
    block = left.column("block").to_numpy()
    rep = left.column("rep").to_numpy()
    items = left.column("items").combine_chunks()
    flat, offsets = items.flatten().to_numpy(), items.offsets.to_numpy()
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    _, vocabulary, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts > 1  # items of one set add nothing to an intersection
    column = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keep = shared[vocabulary]
    label = comp.copy()
    a, b = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    width = max(1, int(shared.sum()))
    inter = np.zeros((len(a), len(b)), dtype=np.float32)
    owner, cells = owner[keep], column[vocabulary[keep]]
    row_of = np.full(len(sizes), -1)
    for start in range(0, width, 4096):  # the product in strips of the vocabulary
        here = (cells >= start) & (cells < start + 4096)
        sides = []
        for rows in (a, b):
            row_of[:] = -1
            row_of[rows] = np.arange(len(rows))
            strip = np.zeros((len(rows), min(4096, width - start)), dtype=np.float32)
            own = row_of[owner[here]]
            mine = own >= 0
            strip[own[mine], cells[here][mine] - start] = 1
            sides.append(strip)
        inter += sides[0] @ sides[1].T
    union = sizes[a][:, None] + sizes[b][None, :] - inter
    links = inter * 100 >= union * 80
    big = np.iinfo(np.int64).max
    while True:  # the smallest label among linked members, until nothing changes
        before = label.copy()
        low = np.where(links, label[b][None, :], big).min(axis=1)
        label[a] = np.minimum(label[a], low)
        low = np.where(links, label[a][:, None], big).min(axis=0)
        label[b] = np.minimum(label[b], low)
        smallest: dict[int, int] = {}
        for c, x in zip(comp.tolist(), label.tolist()):
            smallest[c] = min(x, smallest.get(c, x))
        label = np.array([smallest[c] for c in comp.tolist()], dtype=np.int64)
        if (label == before).all():
            break
    moved = label != comp
    edges = np.unique(np.stack([comp[moved], label[moved]], axis=1), axis=0)
    assert len(rep) >= len(edges)
    return pa.table({"a": edges[:, 0].astype(np.int64), "b": edges[:, 1].astype(np.int64)})


def _long_list_links(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between groups (by their labels) that still meet in a long list."""
    long_lists = members.where(F.col("length") > SHORT_LIST).select("value", "rep", "n", "length")
    named = long_lists.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    fullness = F.greatest(F.max("length") / BLOCK, F.sum("n") / BLOCK_ITEMS)
    spread = named.groupBy("value").agg(
        F.min("comp").alias("lo"),
        F.max("comp").alias("hi"),
        F.ceil(fullness).cast("int").alias("blocks"),
    )
    open_lists = spread.where("lo <> hi").select("value", "blocks")
    left = named.select("value", "rep", "comp").join(open_lists, "value").join(sets, "rep")
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = left.select("value", "rep", "comp", "items", own.alias("block"), other)
    paired = dealt.select(
        "value",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "rep",
        "comp",
        "items",
        "block",
    )
    return paired.groupBy("value", "low", "high").applyInArrow(_forest, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of *docs* (doc_id, text).

    Documents are linked when their sets of *shingle*-word shingles have a Jaccard
    similarity of 0.8 or more; words lie between ASCII white space, with A-Z lowered. A
    text with fewer words has its whole sequence as its one shingle. Without words (NULL,
    empty, white space) the set is empty and the document alone. Rows with a NULL id take no part: their component is NULL and
    they are kept. Rows that repeat an id are one document in the graph of links: what is near
    any of their texts is near the id. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    fields = "doc_id bigint, n_shingles bigint, key_a bigint, key_b bigint, sig binary"
    with Scratch(spark) as scratch:
        prints = scratch.store(docs.mapInArrow(freeing(_fingerprint(shingle)), fields))
        keys = ["key_a", "key_b", "n_shingles"]
        classes = scratch.store(
            prints.where("n_shingles > 0 AND doc_id IS NOT NULL")
            .groupBy(*keys)
            .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
        )
        sketch = spark.sparkContext.broadcast(_sketch(classes))
        posted = scratch.store(
            classes.select("rep", "n_shingles", "sig").mapInArrow(
                _post(sketch), "value bigint, rep bigint, n bigint, typical bigint"
            )
        )
        lists = posted.groupBy("value").agg(
            F.count("*").alias("length"), F.max(F.struct("typical", "rep", "n")).alias("hub")
        )
        members = scratch.store(
            posted.join(lists.where("length > 1"), "value").select(
                "value",
                "rep",
                "n",
                "length",
                F.col("hub.rep").alias("hub"),
                F.col("hub.n").alias("hub_n"),
            )
        )
        short = members.where(F.col("length") <= SHORT_LIST).select("value", "rep", "n")
        one = short.withColumnsRenamed({"rep": "a", "n": "n_a"})
        two = short.withColumnsRenamed({"rep": "b", "n": "n_b"})
        met = one.join(two, "value").where((F.col("a") < F.col("b")) & _close("n_a", "n_b"))
        to_hub = members.where(
            (F.col("length") > SHORT_LIST) & (F.col("rep") != F.col("hub")) & _close("n", "hub_n")
        ).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        pairs = met.select("a", "b").unionByName(to_hub).distinct()
        sig = lambda end: classes.select(F.col("rep").alias(end), F.col("sig").alias(f"sig_{end}"))
        likely = scratch.store(
            pairs.join(sig("a"), "a")
            .join(sig("b"), "b")
            .mapInArrow(_collisions, "a bigint, b bigint")
        )
        in_long = members.where(F.col("length") > SHORT_LIST).select("rep")
        ids = likely.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(in_long)
        ids = scratch.store(ids.distinct())
        sets = scratch.store(_full_sets(docs, ids, shingle))
        links = scratch.store(_confirmed(likely, sets))
        labels = components(links, scratch).withColumnRenamed("node", "rep")
        more = scratch.store(_long_list_links(members, labels, sets))
        named = classes.select(*keys, "rep").join(labels, "rep", "left")
        groups = named.select(*keys, F.coalesce("comp", "rep").alias("group"))
        if not more.isEmpty():
            joined = components(more, scratch).withColumnRenamed("node", "group")
            groups = groups.join(joined, "group", "left").select(
                *keys, F.coalesce("comp", "group").alias("group")
            )
        found = prints.drop("sig").join(groups, keys, "left")
        alone = F.coalesce("group", "doc_id")
        component = F.when(F.col("doc_id").isNotNull(), alone).alias("component_id")
        kept = F.coalesce(F.col("doc_id") == alone, F.lit(True)).alias("kept")
        return result(found.select("doc_id", "n_shingles", component, kept))
