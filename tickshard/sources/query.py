"""SELECT statements as lazy DataFrames."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickshard.names import AXIS
from tickshard.operators.axis import normalize_axis
from tickshard.operators.schema import declare_schema, hide_internal
from tickshard.operators.slices import check_count, partition_by_slice
from tickshard.plans.temporary import materialize as store_result
from tickshard.plans.temporary import materialize_table
from tickshard.sources.ranges import read_slices

# Fixed value: the only statements accepted start with this word, in any case.
_SELECT = re.compile(r"\s*SELECT\b", re.IGNORECASE)


def require_select(sql: str) -> None:
    if not _SELECT.match(sql):
        raise ValueError(f"only SELECT statements can be queried; got {sql!r}")


def _plan(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None) -> DataFrame:
    # The check comes first: Spark would carry out a DROP at once.
    require_select(sql)
    return hide_internal(spark.sql(sql, **views) if views else spark.sql(sql))


def query(
    spark: SparkSession,
    sql: str,
    *,
    schema: T.StructType | None = None,
    npartitions: int = 1,
    views: Mapping[str, DataFrame] | None = None,
    materialize: bool = False,
    persist: bool = False,
    split_rows: int | None = None,
) -> DataFrame:
    """The result of a SELECT as a DataFrame.

    schema
        Declared result schema; the result is aligned to it (see ``declare_schema``).
    npartitions
        1 leaves the partitioning to Spark. More cuts the result into that many
        even time slices, one Spark partition each, in time order; only with *split_rows* does a
        slice above so many rows take several neighbouring partitions. Needs
        ``$timestamp`` in the result, and runs a job for its first and last time.
    views
        DataFrames the text may name as ``{name}``; pass ``read_ranges(...)`` here
        to read only some time of a large table.
    materialize
        Run the statement once into a temporary table and read that. Worth it for
        statements that are costly to run twice, such as joins and window functions.
        Slices of it are range reads without a shuffle.
    persist
        Keep partitions in memory and on disk when first computed.

    Nothing runs before an action unless *npartitions* or *materialize* asks for it.
    Columns starting with ``$`` are internal and left out, the axis excepted.
    """
    check_count(npartitions)
    result = _plan(spark, sql, views)
    if schema is not None:
        result = declare_schema(result, schema)
    if AXIS in result.columns or npartitions > 1 or materialize:
        result = normalize_axis(result)
    if materialize and npartitions > 1:
        result = read_slices(
            spark,
            table=materialize_table(result),
            npartitions=npartitions,
            split_rows=split_rows,
        )
    elif materialize:
        result = store_result(result)
    elif npartitions > 1:
        result = partition_by_slice(result, npartitions, split_rows)
    return result.persist(StorageLevel.MEMORY_AND_DISK) if persist else result


def result_schema(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None
) -> T.StructType:
    """Names and types a SELECT would give; analysis only, no job."""
    result = _plan(spark, sql, views)
    return (normalize_axis(result) if AXIS in result.columns else result).schema


def empty_result(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty DataFrame of *schema*."""
    return spark.createDataFrame([], schema)
