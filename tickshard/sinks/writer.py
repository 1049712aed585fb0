"""Writing frames to time-sharded tables."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import require_utc, width_micros
from tickshard.functions.missing import nan_to_null
from tickshard.names import AXIS, TABLE, is_internal
from tickshard.operators.axis import normalize_axis
from tickshard.operators.schema import coerce, stored_schema
from tickshard.plans.rewrite import (
    append_new,
    append_staged,
    one_per_key,
    replace_matching,
    truncate_range,
)
from tickshard.plans import snapshots
from tickshard.plans.tables import raw_table, shard_width, table_exists, with_shard
from tickshard.sources.local import from_pandas

logger = logging.getLogger("tickshard")

# Names of the push and deduplication modes.
PUSH_MODES = ("fast", "async", "transactional", "truncate")
DEDUPLICATION_MODES = ("drop", "upsert")

DEFAULT_SHARD_SIZE = "1d"


class PendingWrite:
    """A write that runs when called (or on ``compute()``) and then gives ``True``."""

    def __init__(self, run: Callable[[], None]):
        self._run = run

    def __call__(self) -> bool:
        self._run()
        return True

    def compute(self) -> bool:
        return self()


def prepared(df: DataFrame, axis: str | None = None) -> DataFrame:
    """A frame ready to be typed: axis normalised, bookkeeping gone, NaN missing."""
    require_utc(df.sparkSession)
    rows = normalize_axis(df, axis)
    if TABLE in rows.columns:
        logger.warning("column %r is internal and is not written", TABLE)
        rows = rows.drop(TABLE)
    reserved = [c for c in rows.columns if is_internal(c)]
    if reserved:
        raise ValueError(f"columns {reserved} start with '$', which is reserved")
    missing = F.raise_error(F.lit(f"a row has no {AXIS}")).cast("timestamp_ntz")
    present = F.when(F.col(AXIS).isNotNull(), F.col(AXIS)).otherwise(missing)
    return nan_to_null(rows.withColumn(AXIS, present))


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    """Data columns of a stored table."""
    return T.StructType([f for f in raw_table(spark, table).schema if not is_internal(f.name)])


def open_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    *,
    create: bool,
    shard_size: str | int | dt.timedelta | None,
    path: str | None = None,
) -> tuple[T.StructType, int, bool]:
    """Schema and shard width to write with, and whether the table was made just now."""
    if table_exists(spark, table):
        width = shard_width(spark, table)
        if shard_size is not None and width_micros(shard_size) != width:
            raise ValueError(f"{table!r} has shards of {width} us, not {shard_size!r}")
        return table_schema(spark, table), width, False
    if not create:
        raise ValueError(f"table {table!r} does not exist and create is off")
    width = width_micros(DEFAULT_SHARD_SIZE if shard_size is None else shard_size)
    wanted = stored_schema(schema)
    snapshots.create(spark, table, wanted, width, path)
    return wanted, width, True


def dedup_keys(deduplicate: bool | Sequence[str], schema: T.StructType) -> list[str]:
    """``True`` means all columns; a list names the key columns."""
    if deduplicate is True:
        return list(schema.names)
    keys = list(dict.fromkeys(deduplicate or []))
    unknown = [k for k in keys if k not in schema.names]
    if unknown:
        raise ValueError(f"deduplication keys {unknown} are not columns of the table")
    return keys


def store(
    table: str,
    rows: DataFrame,
    *,
    push_mode: str,
    keys: list[str],
    deduplication_mode: str,
    cluster: bool,
    batch: tuple[str, int] | None = None,
) -> None:
    """Put typed rows with ``$shard`` into an existing table. An append remembers *batch*."""
    if push_mode == "truncate":
        truncate_range(table, one_per_key(rows, keys) if keys else rows)
    elif keys and deduplication_mode == "drop":
        append_new(table, rows, keys)
    elif keys:
        replace_matching(table, rows, keys)
    elif push_mode == "transactional" and batch is None:
        append_staged(table, rows)
    else:
        snapshots.Stored(rows.sparkSession, table).append(rows, cluster, batch=batch)


def check_modes(push_mode: str, deduplication_mode: str) -> None:
    if push_mode not in PUSH_MODES:
        raise ValueError(f"push_mode is one of {PUSH_MODES}; got {push_mode!r}")
    if deduplication_mode not in DEDUPLICATION_MODES:
        raise ValueError(
            f"deduplication_mode is one of {DEDUPLICATION_MODES}; got {deduplication_mode!r}"
        )


def write_dataframe(
    df: DataFrame | pd.DataFrame,
    table: str,
    *,
    create: bool = True,
    push_mode: str = "fast",
    shard_size: str | int | dt.timedelta | None = None,
    deduplicate: bool | Sequence[str] = False,
    deduplication_mode: str = "drop",
    infer_types: bool = True,
    axis: str | None = None,
    path: str | None = None,
    cluster: bool = True,
    truncate_nanos: bool = False,
) -> PendingWrite:
    """A write of *df* to *table*; nothing happens before the result is called.

    create
        Make the table if it is absent. Without it an absent table is an error.
    push_mode
        "fast" appends; executors write, and all rows show up in one step at the end.
        "transactional" stages the rows first, so a frame that fails half-way
        never starts writing to the table. "truncate" replaces all stored rows
        between the first and last time of the frame, both included. "async" has
        no acknowledge-before-disk here and appends like "fast"; see
        ``tickshard.streaming`` for continuous input.
    shard_size
        Time covered by one shard of a new table (one day by default). For an
        existing table it must be left out or agree.
    deduplicate, deduplication_mode
        ``True`` compares whole rows, a list of names compares those columns; NULL
        equals NULL. "drop" ignores new rows whose key is stored, "upsert"
        replaces the stored rows. Repeats inside the frame collapse to the row that
        is last by time, then by the other columns.
    infer_types
        Convert columns to the stored types where every value has an exact
        counterpart. Off, the types must match and the plan has no conversion.
    axis
        Name of the time column if it is not ``$timestamp``.
    path
        Folder of a new table, instead of the session's warehouse.
    cluster
        Shuffle rows so that each shard gets few files. Turn it off for input that
        is already in time order; the write is then free of shuffles.
    """
    check_modes(push_mode, deduplication_mode)

    def run() -> None:
        spark = df.sparkSession if isinstance(df, DataFrame) else SparkSession.active()
        frame = df if isinstance(df, DataFrame) else from_pandas(spark, df, truncate_nanos)
        rows = prepared(frame, axis)
        schema, width, made = open_table(
            spark, table, rows.schema, create=create, shard_size=shard_size, path=path
        )
        try:
            typed = with_shard(coerce(rows, schema, infer_types), width)
            store(
                table,
                typed,
                push_mode=push_mode,
                keys=dedup_keys(deduplicate, schema),
                deduplication_mode=deduplication_mode,
                cluster=cluster,
            )
        except Exception:
            if made:
                snapshots.drop(spark, table)
            raise

    return PendingWrite(run)


