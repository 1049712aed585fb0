import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tickshard as ts
from tickshard.operators import coerce, stored_schema

NTZ = "`$timestamp` timestamp_ntz"


def struct(ddl):
    return T.StructType.fromDDL(ddl)


def test_stored_types(spark):
    df = spark.sql(
        """SELECT 1S AS s, 1 AS i, 1L AS l, CAST(1 AS FLOAT) AS f, 1D AS d, 'a' AS t, X'00' AS b,
                  TIMESTAMP'2024-01-01' AS z, TIMESTAMP_NTZ'2024-01-01' AS `$timestamp`,
                  NULL AS n, 'x' AS `$table`"""
    )
    assert stored_schema(df.schema) == struct(
        NTZ + ", s bigint, i bigint, l bigint, f double, d double, t string, b binary, "
        "z timestamp_ntz, n string"
    )


@pytest.mark.parametrize(
    "kind", ["true", "1Y", "array(1)", "map('a', 1)", "1.5BD", "DATE'2024-01-01'", "INTERVAL 1 DAY"]
)
def test_other_types_are_refused(spark, kind):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'2024-01-01' AS `$timestamp`, {kind} AS odd")
    with pytest.raises(TypeError, match="'odd'"):
        stored_schema(df.schema)


def test_coerce_reads_texts_and_exact_numbers(spark):
    df = spark.sql("SELECT '12' AS a, 3D AS b, 4L AS c, 'xy' AS d, X'6162' AS e, 5L AS f")
    out = coerce(df, struct("a bigint, b bigint, c double, d binary, e string, f string, g double"))
    assert out.first() == (12, 3, 4.0, bytearray(b"xy"), "ab", "5", None)


@pytest.mark.parametrize(
    "expression, target",
    [("'12x'", "bigint"), ("1.5D", "bigint"), ("9007199254740993L", "double"), ("X'ff'", "string"),
     ("'noon'", "timestamp_ntz")],
)
def test_coerce_refuses_what_has_no_exact_counterpart(spark, expression, target):
    out = coerce(spark.sql(f"SELECT {expression} AS a"), struct(f"a {target}"))
    with pytest.raises(Exception, match="column 'a' does not fit"):
        out.collect()


def test_coerce_without_inference(spark):
    df = spark.sql("SELECT 1 AS a, 2L AS b")
    with pytest.raises(TypeError, match="'a'"):
        coerce(df, struct("a bigint, b bigint"), infer_types=False)
    plain = coerce(df.select("b"), struct("b bigint"), infer_types=False)
    assert "cast" not in plain._jdf.queryExecution().optimizedPlan().toString().lower()
    with pytest.raises(ValueError, match="not in the table"):
        coerce(df, struct("a bigint"))


def test_declared_schema_orders_widens_and_fills(spark):
    df = spark.sql("SELECT 1 AS a, CAST(2 AS FLOAT) AS b, NULL AS c, 7L AS extra")
    wanted = struct("c bigint, b double, d string, a bigint")
    out = ts.declare_schema(df, wanted)
    assert out.schema.simpleString() == wanted.simpleString() and out.first() == (None, 2.0, None, 1)


def test_declared_schema_takes_all_missing_floats_and_whole_floats(spark):
    rows = [(float("nan"), 1.0), (None, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double")
    out = ts.declare_schema(df, struct("a string, b bigint"))
    assert sorted(map(tuple, out.collect()), key=str) == [(None, 1), (None, None)]
    for bad in ("a bigint, b string", "b timestamp_ntz"):
        with pytest.raises(Exception, match="does not fit"):
            ts.declare_schema(df, struct(bad)).collect()


def test_declared_schema_never_narrows(spark):
    with pytest.raises(TypeError):
        ts.declare_schema(spark.range(1), struct("id int"))
    with pytest.raises(TypeError):
        ts.declare_schema(spark.sql("SELECT '1' AS id"), struct("id bigint"))
    required = T.StructType([T.StructField("gone", T.LongType(), nullable=False)])
    with pytest.raises(ValueError, match="gone"):
        ts.declare_schema(spark.range(1), required)


def test_internal_columns_are_hidden(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS `$shard`, 3 AS `$timestamp`, 4 AS `$table`")
    assert ts.hide_internal(df).columns == ["a", "$timestamp"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), "y"), (None, "z")], "v double, s string")
    assert [r.v for r in ts.nan_to_null(df).collect()] == [1.0, None, None]
    assert math.isnan(ts.nan_to_null(df, "s").collect()[1].v)


def test_empty_frame_keeps_schema(spark):
    schema = struct(NTZ + ", a bigint, b array<float>")
    df = ts.empty_result(spark, schema)
    assert df.schema == schema and df.count() == 0
    filtered = ts.time_range(
        spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, [1.0])], schema), "2025-01-01", "2026-01-01"
    )
    assert filtered.schema == schema and filtered.count() == 0
    assert filtered.agg(F.count("*")).first()[0] == 0
