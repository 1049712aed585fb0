"""Which shards can hold a key: a Bloom filter and a key range for each shard of a write.

An indexed table keeps, for each generation, one small Parquet folder beside its rows:
for each shard the first and last value of the first key column and the shard's filter in
blocks of 4 KiB. A key belongs to one block, by the leading bits of a hash, and sets eight
bits there; a shard has as many blocks as its keys need, a power of two. A batch meets the
blocks its keys belong to in a join and opens only the shards where all bits of one of its
keys are set. A filter may say yes to a key that is not there and never no to one that is,
so the rows a write finds are the same as without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickshard.names import GEN, SHARD
from tickshard.operators.schema import named

FOLDER = "_keys"  # hidden from Spark's listings
BLOCK_BITS = 1 << 15
KEYS_PER_BLOCK = 1 << 10
POSITIONS = 8
#: A larger batch scans the stored keys: it would meet most shards anyway.
MOST_KEYS = 100_000


def _positions(keys: Sequence[str]) -> Column:
    """The bits of a key inside its block, from two hashes."""
    hashes = [F.xxhash64(F.lit(salt), *[named(k) for k in keys]) for salt in (1, 2)]
    parts = [
        F.shiftrightunsigned(h, 15 * i).bitwiseAND(BLOCK_BITS - 1)
        for h in hashes
        for i in range(POSITIONS // 2)
    ]
    return F.array(*parts)


def _block(keys: Sequence[str], level: Column) -> Column:
    """The block of a key among ``2 ** level``: leading bits of a hash of 32 bits."""
    lead = F.shiftrightunsigned(F.xxhash64(F.lit(0), *[named(k) for k in keys]), 32)
    return F.floor(lead * F.pow(F.lit(2.0), level - 32)).cast("bigint")


def built(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(shard, level, block, bits, lo, hi) for rows with their ``$shard``."""
    first = named(keys[0])
    sizes = rows.groupBy(F.col(SHARD).alias("shard")).agg(
        F.greatest(F.ceil(F.log2(F.count("*") / F.lit(KEYS_PER_BLOCK))), F.lit(0)).cast("int").alias("level"),
        F.min(first).alias("lo"),
        F.max(first).alias("hi"),
        (F.count("*") > F.count(first)).alias("blank"),
    )
    placed = rows.select(F.col(SHARD).alias("shard"), *[named(k) for k in keys]).join(sizes, "shard")
    bits = placed.select(
        *["shard", "level", "lo", "hi", "blank"],
        _block(keys, F.col("level")).alias("block"),
        F.explode(_positions(keys)).alias("at"),
    )
    return bits.groupBy("shard", "level", "lo", "hi", "blank", "block").agg(
        F.bitmap_construct_agg("at").alias("bits")
    )


def shards_with(index: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(shard): the shards of *index* that may hold a key of *batch*."""
    wanted = batch.select(*[named(k) for k in keys]).distinct()
    ends = wanted.agg(
        F.min(named(keys[0])).alias("least"),
        F.max(named(keys[0])).alias("most"),
        (F.count("*") > F.count(named(keys[0]))).alias("some_blank"),
    )
    ranged = (F.col("lo") <= F.col("most")) & (F.col("hi") >= F.col("least"))
    ranged = F.coalesce(ranged, F.lit(False)) | (F.col("blank") & F.col("some_blank"))
    near = index.join(F.broadcast(ends), ranged).select("shard", "level", "block", "bits")
    levels = index.select("level").distinct()  # a few numbers
    asked = wanted.withColumn("positions", _positions(keys)).join(F.broadcast(levels))
    asked = asked.select("level", _block(keys, F.col("level")).alias("block"), "positions")
    byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = lambda p: F.getbit(byte(p).cast("bigint"), (p % 8).cast("int")) == 1
    return near.join(asked, ["level", "block"]).where(F.forall("positions", is_set)).select("shard").distinct()


def folder(root: str, gen: int | None = None) -> str:
    return f"{root}/{FOLDER}" if gen is None else f"{root}/{FOLDER}/{GEN}={gen}"
