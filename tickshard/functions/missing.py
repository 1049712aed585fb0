"""One notion of "missing": a float NaN becomes NULL, once, on the way in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.names import quoted_column


def is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def null_if_nan(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Turn NaN into NULL in *columns* (all float columns when none are named)."""
    floats = [f.name for f in df.schema if is_float(f.dataType)]
    wanted = [c for c in (columns or floats) if c in floats]
    if not wanted:
        return df
    return df.withColumns({c: null_if_nan(F.col(quoted_column(c))) for c in wanted})
