"""Balanced label propagation: documents move to their neighbours' shards in equal exchange.

Documents with equal texts are linked. All start in shards of equal count. In each round a
linked document wants the shard where most of its neighbours are; between each two shards
as many documents move one way as the other, and documents without links fill in for what
has no counterpart, so counts stay at most one apart whatever moves. Groups too large for
a shard are cut into parts first: their copies can't all be neighbours.

Only DataFrame operations: no task holds a group, and what crosses shards is a table of
one row for each two shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch, ranked, result, text_or_empty

ROUNDS = 4
#: Cells for ranks over all rows, and for ranks in one shard or between two.
WAYS, LANE_WAYS = 2048, 64
#: Bytes a document counts besides those of its text.
ROW_BYTES = 16
#: Lanes of documents that stay where they are, and of those without links.
STAYS, FREE = -2, -1


def _units(rows: DataFrame, shards: int) -> DataFrame:
    """*rows* with ``unit``: the part of the group of equal texts, NULL without a neighbour."""
    room = max(1, rows.count() // (2 * shards))
    groups = rows.groupBy("text_key").agg(F.count("*").alias("copies")).where("copies > 1")
    linked = groups.select("text_key", F.ceil(F.col("copies") / room).alias("parts"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    unit = F.when(F.col("parts").isNotNull(), F.xxhash64("text_key", part))
    return rows.join(linked, "text_key", "left").withColumn("unit", unit).drop("parts", "text_key")


def _round(state: DataFrame) -> DataFrame:
    """One exchange."""
    votes = state.where("unit IS NOT NULL").groupBy("unit", "shard").agg(F.count("*").alias("n"))
    # ties go to the smallest shard, so no two documents swap for ever
    best = votes.groupBy("unit").agg(F.max(F.struct("n", (-F.col("shard")).alias("minus"))).alias("best"))
    goal = votes.join(best, "unit").select("unit", "shard", (-F.col("best.minus")).alias("goal"))
    lane = (
        F.when(F.col("unit").isNull(), FREE)
        .when(F.col("goal") != F.col("shard"), F.col("goal"))
        .otherwise(STAYS)
        .cast("int")
    )
    wishes = state.join(goal, ["unit", "shard"], "left").withColumn("lane", lane).drop("goal")
    counts = wishes.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    movers = counts.where("lane >= 0")
    back = movers.select(
        F.col("lane").alias("shard"), F.col("shard").alias("lane"), F.col("n").alias("n_back")
    )
    free = counts.where(F.col("lane") == FREE).select(
        F.col("shard").alias("lane"), F.col("n").alias("free")
    )
    swapped = F.least("n", F.coalesce("n_back", F.lit(0)))
    pairs = (
        movers.join(back, ["shard", "lane"], "left")
        .join(free, "lane", "left")
        .select("shard", "lane", swapped.alias("swapped"), (F.col("n") - swapped).alias("rest"), "free")
    )
    earlier = (
        Window.partitionBy("lane").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("rest").over(earlier), F.lit(0))
    room = F.greatest(F.coalesce("free", F.lit(0)) - F.col("before"), F.lit(0))
    pairs = pairs.withColumn("before", before).withColumn("filled", F.least("rest", room))
    leave = pairs.select(
        "shard",
        "lane",
        F.array(
            F.struct((F.col("swapped") + F.col("filled")).alias("upto"), F.col("lane").alias("to"))
        ).alias("moves"),
    )
    fill = (
        pairs.where("filled > 0")
        .groupBy(F.col("lane").alias("shard"))
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (F.col("before") + F.col("filled")).alias("upto"), F.col("shard").alias("to")
                    )
                )
            ).alias("moves")
        )
        .select("shard", F.lit(FREE).alias("lane"), "moves")
    )
    # at most one row for each two shards, and one for each shard
    plan = F.broadcast(leave.unionByName(fill))
    placed = ranked(wishes, ["shard", "lane"], ["doc_id", "text_crc32"], "turn", LANE_WAYS)
    move = F.filter("moves", lambda m: F.col("turn") < m["upto"])
    moved = F.coalesce(F.try_element_at(move, F.lit(1))["to"], F.col("shard")).cast("int")
    return placed.join(plan, ["shard", "lane"], "left").select(
        "doc_id", "size", "text_crc32", "unit", moved.alias("shard")
    )


def shard_documents(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of *docs*.

    Law ``rows``: counts of shards are at most one apart; ``grown_shard`` is NULL. ``size``
    is the text's UTF-8 bytes plus 16 and ``slot`` numbers the rows of a shard from 0. A
    NULL text counts as empty, and all such are one group. NULL or repeated ids are rows
    like others; other columns are ignored; an empty table has no rows.
    """
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("text_key"),
    )
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.store(rows)
        dealt = ranked(
            _units(rows, shards).withColumn("all", F.lit(0)),
            ["all"],
            ["doc_id", "text_crc32"],
            "place",
            WAYS,
        )
        shard = F.pmod("place", F.lit(shards)).cast("int").alias("shard")
        state = scratch.store(dealt.select("doc_id", "size", "text_crc32", "unit", shard))
        for _ in range(rounds):
            state = scratch.store(_round(state))
        slotted = ranked(state, ["shard"], ["doc_id", "text_crc32"], "slot", 4 * LANE_WAYS)
        return result(
            slotted.select(
                "doc_id",
                "size",
                "text_crc32",
                F.lit("rows").alias("law"),
                "shard",
                "slot",
                F.lit(None).cast("int").alias("grown_shard"),
            )
        )
