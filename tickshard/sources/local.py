"""Local pandas frames as Spark input."""

from __future__ import annotations

import pandas as pd
from pandas.api import types as kinds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickshard.names import AXIS


def _spark_type(name: str, values: pd.Series) -> T.DataType:
    dtype = values.dtype
    if kinds.is_bool_dtype(dtype) or kinds.is_unsigned_integer_dtype(dtype) or dtype == "int8":
        raise TypeError(f"column {name!r} of type {dtype} cannot be stored")
    if kinds.is_integer_dtype(dtype):
        return T.LongType()
    if kinds.is_float_dtype(dtype):
        return T.DoubleType()
    if kinds.is_datetime64_any_dtype(dtype):
        return T.TimestampNTZType()
    if kinds.is_object_dtype(dtype) or kinds.is_string_dtype(dtype):
        found = {type(v) for v in values if not pd.isna(v)}
        if found <= {bytes, bytearray} and found:
            return T.BinaryType()
        if found <= {str}:
            return T.StringType()
        raise TypeError(f"column {name!r} mixes or holds {sorted(t.__name__ for t in found)}")
    raise TypeError(f"column {name!r} of type {dtype} cannot be stored")


def from_pandas(
    spark: SparkSession, frame: pd.DataFrame, truncate_nanos: bool = False
) -> DataFrame:
    """A local frame as a DataFrame with the axis as a column.

    A time index becomes ``$timestamp``. Half floats widen, bytes stay binary, zoned
    times become UTC, missing values of every kind become NULL. A time finer
    than a microsecond is a ``ValueError``, or is cut with *truncate_nanos*. A frame without ``$timestamp`` and without a time index is a
    ``ValueError``.
    """
    timed = kinds.is_datetime64_any_dtype(frame.index.dtype)
    if AXIS not in frame.columns:
        if not timed and frame.index.name != AXIS:
            raise ValueError(f"the frame has neither a time index nor a {AXIS!r} column")
        frame = frame.rename_axis(AXIS).reset_index()

    schema = T.StructType(
        [T.StructField(str(c), _spark_type(str(c), frame[c])) for c in frame.columns]
    )
    ready = {}
    for column, field in zip(frame.columns, schema):
        values = frame[column]
        if isinstance(field.dataType, T.DoubleType):
            values = values.astype("float64")
        elif isinstance(field.dataType, T.TimestampNTZType):
            if isinstance(values.dtype, pd.DatetimeTZDtype):
                values = values.dt.tz_convert("UTC").dt.tz_localize(None)
            exact = values.astype("datetime64[us]")
            if not truncate_nanos and not (exact.astype(values.dtype) == values)[values.notna()].all():
                raise ValueError(f"column {field.name!r} has times finer than a microsecond")
            values = exact
        elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
            values = values.astype(object).where(values.notna(), None)
        ready[field.name] = values
    return spark.createDataFrame(pd.DataFrame(ready), schema=schema)
