"""Plain stored tables: Parquet in the session catalog, partitioned by ``$shard``.

``$shard`` is ``floor(axis / width)``; the width of a table is one of its
properties. Materialised results are such tables; those that are written to again are in
``tickshard.plans.snapshots``. Shard numbers collected to the driver are partition metadata of the
catalog (one integer per touched shard), never data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.clock import shard_of
from tickshard.names import AXIS, SHARD, is_internal, quoted_column
from tickshard.operators.axis import in_runs

WIDTH_PROPERTY = "tickshard.shard.micros"
PARTITIONS_PER_STATEMENT = 500
NO_SHARD = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name of the NULL partition


def quoted(table: str) -> str:
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in table.split("."))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quoted(table))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect()
    return {row["key"]: row["value"] for row in rows}


def shard_width(spark: SparkSession, table: str) -> int:
    found = properties(spark, table).get(WIDTH_PROPERTY)
    if found is None or SHARD not in spark.table(quoted(table)).columns:
        raise ValueError(f"{table!r} is not a time-sharded table")
    return int(found)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()
    # The last one: a column may be called "Location", too.
    return [row["data_type"] for row in rows if row["col_name"] == "Location"][-1]


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    width: int,
    path: str | None = None,
    extra: dict[str, str] | None = None,
) -> None:
    nullable = [T.StructField(f.name, f.dataType) for f in schema]
    columns = T.StructType([*nullable, T.StructField(SHARD, T.LongType())]).toDDL()
    settings = {WIDTH_PROPERTY: str(width), **(extra or {})}
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in settings.items())
    statement = (
        f"CREATE TABLE {quoted(table)} ({columns}) USING parquet "
        f"PARTITIONED BY ({quoted_column(SHARD)}) TBLPROPERTIES ({listed})"
    )
    if path is not None:
        escaped = path.replace("\\", "\\\\").replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)


def raw_table(spark: SparkSession, table: str) -> DataFrame:
    """The table with its ``$shard`` column."""
    return spark.table(quoted(table))


def with_shard(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn(SHARD, shard_of(AXIS, width))


def in_shards(shards: Iterable[int]) -> Column:
    """Partition filter for *shards*; runs of neighbours become one comparison."""
    return in_runs((shard, shard) for shard in set(shards))


def plain_shards(spark: SparkSession, table: str) -> list[int | None]:
    """Shards the catalog knows; no data is read. ``None`` stands for rows without a
    time, which only materialised results can have."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()
    values = [row["partition"].split("=", 1)[1] for row in rows]
    return [None if v == NO_SHARD else int(v) for v in values]


def clustered(df: DataFrame) -> DataFrame:
    """Rows of a shard side by side and in time order, so that a shard gets few files
    and row groups prune by time.

    REBALANCE lets adaptive execution split a shard above the advisory partition
    size over several tasks (by map output, so equal rows split as well) and join
    small shards into one task.
    """
    return df.hint("rebalance", F.col(SHARD)).sortWithinPartitions(SHARD, AXIS)


def in_table_order(schema: T.StructType, rows: DataFrame) -> DataFrame:
    """*rows* with the table's columns in its order; bookkeeping they lack is NULL."""
    columns = []
    for field in schema:
        absent = field.name not in rows.columns and is_internal(field.name)
        column = F.lit(None).cast(field.dataType) if absent else F.col(quoted_column(field.name))
        columns.append(column.alias(field.name))
    return rows.select(columns)


def append_rows(spark: SparkSession, table: str, rows: DataFrame, cluster: bool = True) -> None:
    """Append *rows* (with ``$shard``); files show up when the job commits."""
    ordered = in_table_order(raw_table(spark, table).schema, rows)
    (clustered(ordered) if cluster else ordered).write.insertInto(quoted(table))
