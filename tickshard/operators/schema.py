"""Column types: what a stored table may hold and how other types get there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickshard.functions.missing import is_float, null_if_nan
from tickshard.names import AXIS, is_internal, quoted_column
from tickshard.operators.axis import or_fail

# Input type -> stored type. Anything else is not storable.
STORED_TYPES = {
    T.LongType(): T.LongType(),
    T.IntegerType(): T.LongType(),
    T.ShortType(): T.LongType(),
    T.DoubleType(): T.DoubleType(),
    T.FloatType(): T.DoubleType(),
    T.StringType(): T.StringType(),
    T.BinaryType(): T.BinaryType(),
    T.TimestampType(): T.TimestampNTZType(),
    T.TimestampNTZType(): T.TimestampNTZType(),
    T.NullType(): T.StringType(),  # an untyped all-missing column counts as text
}

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_FRACTION = (T.FloatType(), T.DoubleType())


def named(name: str) -> Column:
    return F.col(quoted_column(name))


def stored_type(name: str, data_type: T.DataType) -> T.DataType:
    if data_type not in STORED_TYPES:
        raise TypeError(f"column {name!r} of type {data_type.simpleString()} cannot be stored")
    return STORED_TYPES[data_type]


def stored_schema(schema: T.StructType) -> T.StructType:
    """Schema of a table that can hold *schema*: axis first, internal columns left out."""
    fields = [T.StructField(AXIS, T.TimestampNTZType())]
    for field in schema:
        if field.name != AXIS and not is_internal(field.name):
            fields.append(T.StructField(field.name, stored_type(field.name, field.dataType)))
    return T.StructType(fields)


def hide_internal(df: DataFrame) -> DataFrame:
    """Drop every ``$`` column but the axis."""
    hidden = [c for c in df.columns if is_internal(c)]
    return df.drop(*hidden) if hidden else df


def _whole_number(value: Column, target: T.DataType) -> Column:
    """A float as an integer where it is one; a fraction gives NULL."""
    number = value.try_cast(target)
    return F.when(number.cast(T.DoubleType()) == value, number)


def _converted(field: T.StructField, target: T.DataType) -> Column:
    """*field* as *target*. Values that have no exact counterpart fail the job."""
    source, column = field.dataType, named(field.name)
    if is_float(source):
        column = null_if_nan(column)
    if source == target:
        return column
    stored_type(field.name, source)
    message = f"column {field.name!r} does not fit {target.simpleString()}"

    if isinstance(source, T.NullType) or STORED_TYPES[source] == target:
        return column.cast(target)
    if isinstance(target, T.LongType) and is_float(source):
        return or_fail(_whole_number(column, target), column, message)
    if isinstance(target, T.DoubleType) and source in _WHOLE:
        exact = F.when(column.cast(target).try_cast(source) == column, column.cast(target))
        return or_fail(exact, column, message)
    if isinstance(target, T.StringType):
        text = column.cast(target)
        if isinstance(source, T.BinaryType):
            return or_fail(F.when(F.is_valid_utf8(text), text), F.hex(column), message)
        return text
    if isinstance(source, T.StringType):
        if isinstance(target, T.BinaryType):
            return column.cast(target)
        if isinstance(target, T.TimestampNTZType):
            return or_fail(column.try_cast("timestamp_ltz").cast(target), column, message)
        return or_fail(column.try_cast(target), column, message)
    raise TypeError(f"{message}: its type is {source.simpleString()}")


def coerce(df: DataFrame, target: T.StructType, infer_types: bool = True) -> DataFrame:
    """Project *df* onto the stored schema *target*.

    ``infer_types=True`` converts where every value has an exact counterpart.
    ``False`` adds no conversion at all: the types must match already. Columns the
    frame lacks become NULL; columns the table lacks are an error.
    """
    have = {f.name: f for f in df.schema}
    unknown = [c for c in have if c not in target.names]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the table; it has {target.names}")

    columns = []
    for field in target:
        source = have.get(field.name)
        if source is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if not infer_types and source.dataType != field.dataType:
            raise TypeError(
                f"column {field.name!r} is {source.dataType.simpleString()}, the table has "
                f"{field.dataType.simpleString()}, and infer_types is off"
            )
        columns.append(_converted(source, field.dataType).alias(field.name))
    return df.select(columns)


def _declared(field: T.StructField, target: T.DataType) -> Column:
    source, column = field.dataType, named(field.name)
    if source == target:
        return column
    if isinstance(source, T.NullType):
        return column.cast(target)
    for ladder in (_WHOLE, _FRACTION, _WHOLE + _FRACTION):
        if source in ladder and target in ladder and ladder.index(source) < ladder.index(target):
            return column.cast(target)
    message = f"column {field.name!r} does not fit the declared {target.simpleString()}"
    if is_float(source):
        # Integers with gaps, and all-missing columns of any type, arrive as floats.
        value = null_if_nan(column)
        fits = _whole_number(value, target) if target in _WHOLE else F.lit(None).cast(target)
        return or_fail(fits, value, message)
    raise TypeError(f"{message}: its type is {source.simpleString()}")


def declare_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give *df* the names, order and types of *schema* without looking at the data.

    Widening is free, missing nullable columns become NULL, and a float column
    whose values are all missing takes the declared type. Narrowing is an error.
    """
    have = {f.name: f for f in df.schema}
    columns = []
    for field in schema:
        if field.name in have:
            columns.append(_declared(have[field.name], field.dataType).alias(field.name))
        elif field.nullable:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"required column {field.name!r} is not in the result")
    return df.select(columns)
