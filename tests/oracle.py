"""Spark result against DuckDB on the same Parquet files: names, types, values."""

import math
from collections import Counter
from pathlib import Path

import duckdb

# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else float(f"{v:.10g}")
    return v


def differences(df, con, sql):
    """A list of differences, empty when both results are the same."""
    answer = con.sql(sql)
    found = []
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    duck_types = dict(zip(answer.columns, map(str, answer.types)))
    if spark_types != duck_types:
        found.append(f"schema: {spark_types} != {duck_types}")
        return found
    names = sorted(spark_types)
    mine = Counter(tuple(map(_value, row)) for row in df.select([f"`{n}`" for n in names]).collect())
    order = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(
        tuple(map(_value, row)) for row in con.sql(f"SELECT {order} FROM ({sql})").fetchall()
    )
    if mine != theirs:
        found.append(
            f"rows: {sum(mine.values())} and {sum(theirs.values())}; only here "
            f"{list((mine - theirs).items())[:3]}; only there {list((theirs - mine).items())[:3]}"
        )
    return found
