"""Continuous writes: micro-batches of a streaming frame into a stored table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickshard.operators.schema import coerce
from tickshard.plans.snapshots import Stored
from tickshard.plans.tables import with_shard
from tickshard.sinks.writer import check_modes, dedup_keys, open_table, prepared, store


def write_stream(
    df: DataFrame,
    table: str,
    *,
    checkpoint: str,
    name: str | None = None,
    create: bool = True,
    shard_size: str | int | dt.timedelta | None = None,
    push_mode: str = "fast",
    deduplicate: bool | Sequence[str] = False,
    deduplication_mode: str = "drop",
    infer_types: bool = True,
    axis: str | None = None,
    path: str | None = None,
    available_now: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Start writing the streaming frame *df* to *table*, batch by batch.

    A batch can come twice: Spark repeats one whose write finished but was not yet
    noted in the checkpoint. The step that shows an appended batch's rows therefore also
    notes its number in the table's version, and the first batch after a start is left out
    when its number is there already. Truncating and deduplicating writes are the same
    when repeated and need no check. *name* tells streams into one table apart; by
    default it is the checkpoint folder.

    available_now
        Take what is there and stop.
    interval
        Time between batches, such as "1 minute".
    """
    check_modes(push_mode, deduplication_mode)
    stream = checkpoint if name is None else name
    appends = push_mode != "truncate" and not deduplicate
    seen_first = False

    def put(batch: DataFrame, number: int) -> None:
        nonlocal seen_first
        spark = batch.sparkSession
        rows = prepared(batch, axis)
        schema, width, made = open_table(
            spark, table, rows.schema, create=create, shard_size=shard_size, path=path
        )
        typed = with_shard(coerce(rows, schema, infer_types), width)
        check = appends and not made and not seen_first
        seen_first = True
        if check and Stored(spark, table).base.batches.get(stream) == number:
            return
        store(
            table,
            typed,
            push_mode=push_mode,
            keys=dedup_keys(deduplicate, schema),
            deduplication_mode=deduplication_mode,
            cluster=True,
            batch=(stream, number) if appends else None,
        )

    writer = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval is not None:
        writer = writer.trigger(processingTime=interval)
    return writer.start()
