"""Intermediate results in the shared folder, and ranks that need no single task."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickshard.plans.temporary import expire_temp, fixed, temp_name


#: What Python gets at once: texts may be long, and two workers share an executor. A batch
#: ends at either bound; one row may be larger.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


class Scratch:
    """Tables in the folder of ``spark.checkpoint.dir`` that a block of work needs.

    ``store`` evaluates a frame once, so a lost executor costs one read and not a
    second run, and every reader sees the same rows. All tables go when the block ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._stored: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        expire_temp(self.spark)
        return self

    def __exit__(self, *error) -> None:
        for _, name in self._stored.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def store(self, df: DataFrame) -> DataFrame:
        name = temp_name(self.spark, "stage")
        try:
            df.write.format("parquet").option("compression", "zstd").saveAsTable(name)
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            raise
        table = self.spark.table(name)
        self._stored[id(table)] = (table, name)
        return table

    def drop(self, df: DataFrame) -> None:
        """Drop what ``store`` returned before the block ends."""
        _, name = self._stored.pop(id(df))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def result(df: DataFrame) -> DataFrame:
    """*df* evaluated once into a temporary table that outlives its block; it expires in a day."""
    return fixed(df, compression="zstd")


def freeing(run):
    """*run*, a function of Arrow batches, that gives memory back when it ends.

    Workers are used again for other tasks; what their allocators keep would add up.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := _malloc_trim():
                trim(0)

    return wrapped


@functools.cache
def _malloc_trim():
    """The C library's call that returns free memory to the system, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, ways: int | Column
) -> DataFrame:
    """*df* with the place from 0 of each row among the rows of its *keys*.

    Rows of a key are dealt into *ways* cells by a hash of *order*; a cell's rows follow
    those of the cells before it. So no task needs all rows of a key, and only one count
    for each key and cell crosses cells. *keys* must have few values, none of them NULL.
    """
    cell, before = f"{name}_cell", f"{name}_before"
    keys = list(keys)
    ways = ways if isinstance(ways, Column) else F.lit(ways)
    celled = df.withColumn(cell, F.pmod(F.xxhash64(*order), ways).cast("int"))
    counts = celled.groupBy(*keys, cell).agg(F.count("*").alias(before))
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    inside = Window.partitionBy(*keys, cell).orderBy(*order)
    placed = celled.withColumn(name, F.row_number().over(inside))
    return (
        placed.join(offsets, [*keys, cell])
        .withColumn(name, (F.col(name) - 1 + F.col(before)).cast("bigint"))
        .drop(cell, before)
    )


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
