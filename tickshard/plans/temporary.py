"""Temporary tables in the shared folder: results written once and read many times.

They live in their own database under ``spark.checkpoint.dir``, so every executor
reads them and none of them is lost with an executor. Names start with the time of
creation and carry a lifetime; ``expire_temp`` drops the ones past it.
"""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import instant_micros, require_utc, width_micros
from tickshard.operators.axis import normalize_axis
from tickshard.operators.schema import hide_internal
from tickshard.plans.snapshots import drop
from tickshard.plans.tables import (
    append_rows,
    create_table,
    properties,
    quoted,
    raw_table,
    with_shard,
)

TEMP_DATABASE = "tickshard_temp"
TTL_PROPERTY = "tickshard.ttl.micros"
CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_FOLDER = "tickshard.local.folder"
DEFAULT_TTL = "1d"
LEFTOVER_TTL = "7d"  # of a table whose driver was lost while using it

_NAME = re.compile(r"[a-z]+_(\d{20})_[0-9a-f]{32}")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh local one. A cluster without
    it is an error: a folder of one machine would not be seen by the others.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(LOCAL_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tickshard-")
    spark.conf.set(LOCAL_FOLDER, folder)
    return folder


def temp_database(spark: SparkSession) -> str:
    if not spark.catalog.databaseExists(TEMP_DATABASE):
        escaped = f"{shared_folder(spark)}/{TEMP_DATABASE}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {TEMP_DATABASE} LOCATION '{escaped}'")
    return TEMP_DATABASE


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def temp_name(spark: SparkSession, kind: str = "tmp") -> str:
    """A fresh table name; names sort by time of creation."""
    created = instant_micros(_now())
    return f"{temp_database(spark)}.{kind}_{created:020d}_{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """*df* evaluated once into the shared folder; dropped when the block ends."""
    spark = df.sparkSession
    name = temp_name(spark, "stage")
    try:
        df.write.format("parquet").saveAsTable(quoted(name))
        yield spark.table(quoted(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def fixed(
    df: DataFrame, ttl: str | int | dt.timedelta = DEFAULT_TTL, compression: str = "snappy"
) -> DataFrame:
    """*df* evaluated once into a temporary table, so that all its readers see the same
    rows even where a second evaluation could place or order them differently."""
    spark = df.sparkSession
    name = temp_name(spark)
    df.write.format("parquet").option("compression", compression).saveAsTable(quoted(name))
    spark.sql(
        f"ALTER TABLE {quoted(name)} SET TBLPROPERTIES ('{TTL_PROPERTY}' = '{width_micros(ttl)}')"
    )
    return spark.table(quoted(name))


def storable(df: DataFrame) -> DataFrame:
    """*df* with untyped NULL columns as text; Parquet has no untyped column."""
    untyped = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    return df.withColumns({c: F.lit(None).cast("string") for c in untyped}) if untyped else df


def materialize_table(
    df: DataFrame,
    *,
    shard_size: str | int | dt.timedelta = "1d",
    ttl: str | int | dt.timedelta = DEFAULT_TTL,
) -> str:
    """Run *df* once, store the result as a temporary table and return its name."""
    spark = df.sparkSession
    require_utc(spark)
    width = width_micros(shard_size)
    rows = storable(hide_internal(normalize_axis(df)))
    name = temp_name(spark)
    create_table(spark, name, rows.schema, width, extra={TTL_PROPERTY: str(width_micros(ttl))})
    try:
        append_rows(spark, name, with_shard(rows, width))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")
        raise
    return name


def materialize(
    df: DataFrame,
    *,
    shard_size: str | int | dt.timedelta = "1d",
    ttl: str | int | dt.timedelta = DEFAULT_TTL,
) -> DataFrame:
    """Run *df* once, store it as a temporary table and return the stored rows.

    For results that are costly to compute (as-of joins, window functions) and
    read several times. Any Spark type is kept as it is; only the axis is checked.
    """
    name = materialize_table(df, shard_size=shard_size, ttl=ttl)
    return hide_internal(raw_table(df.sparkSession, name))


def temp_tables(spark: SparkSession) -> list[str]:
    database = temp_database(spark)
    rows = spark.sql(f"SHOW TABLES IN {database}").collect()
    return sorted(f"{database}.{r['tableName']}" for r in rows if not r["isTemporary"])


def expire_temp(spark: SparkSession, now: dt.datetime | str | None = None) -> list[str]:
    """Drop temporary tables older than their lifetime; returns their names.

    The clock runs from creation, which the name holds, and not from the rows'
    times, so a result about old data lives as long as any other. Tables without a
    lifetime of their own, such as a batch a lost driver had staged, get a week.
    """
    moment = instant_micros(_now() if now is None else now)
    dropped = []
    for name in temp_tables(spark):
        stamp = _NAME.fullmatch(name.split(".")[-1])
        if stamp is None:
            continue
        ttl = int(properties(spark, name).get(TTL_PROPERTY, width_micros(LEFTOVER_TTL)))
        if moment - int(stamp[1]) > ttl:
            drop(spark, name)
            dropped.append(name)
    return dropped
