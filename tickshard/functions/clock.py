"""Time arithmetic on the microsecond axis.

Everything is integer microseconds since 1970-01-01 UTC. ``TIMESTAMP_NTZ`` has
no zone, and Spark offers no direct NTZ-to-integer function, so the conversion
goes through ``TIMESTAMP`` and needs the session zone to be UTC.
"""

from __future__ import annotations

import datetime as dt
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tickshard.names import AXIS

# Unit names accepted in width texts such as "1h" or "1d".
UNIT_MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "min": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
    "w": 604_800_000_000,
}

_WIDTH = re.compile(r"\s*(\d+)\s*([a-z]+)\s*")
_EPOCH = dt.datetime(1970, 1, 1)
_ONE_MICRO = dt.timedelta(microseconds=1)


def require_utc(spark: SparkSession) -> None:
    """Raise ``ValueError`` unless the session zone is UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone!r}")


def width_micros(width: str | int | dt.timedelta) -> int:
    """A positive width in microseconds from "1h", a timedelta or an integer."""
    if isinstance(width, dt.timedelta):
        micros = width // _ONE_MICRO
    elif isinstance(width, str):
        match = _WIDTH.fullmatch(width)
        if match is None or match[2] not in UNIT_MICROS:
            raise ValueError(f"not a time width: {width!r}")
        micros = int(match[1]) * UNIT_MICROS[match[2]]
    elif isinstance(width, int) and not isinstance(width, bool):
        micros = width
    else:
        raise TypeError(f"a time width is a text, timedelta or integer; got {width!r}")
    if micros <= 0:
        raise ValueError(f"a time width must be positive; got {width!r}")
    return micros


def instant_micros(value: str | dt.datetime | np.datetime64 | pd.Timestamp) -> int:
    """Microseconds of a bound. A finer bound rounds up, which on a microsecond
    axis keeps both ``ts >= bound`` and ``ts < bound`` exact."""
    stamp = pd.Timestamp(value)
    if stamp is pd.NaT:
        raise ValueError("a time bound cannot be missing")
    if stamp.tzinfo is not None:
        stamp = stamp.tz_convert("UTC").tz_localize(None)
    micros = (stamp.to_pydatetime(warn=False) - _EPOCH) // _ONE_MICRO
    return micros + (1 if stamp.nanosecond else 0)


def instant_literal(micros: int) -> Column:
    """A ``TIMESTAMP_NTZ`` literal that reaches the Parquet scan as a pushed filter."""
    return F.lit((_EPOCH + micros * _ONE_MICRO).isoformat(sep=" ")).cast("timestamp_ntz")


def micros(axis: Column | str = AXIS) -> Column:
    return F.unix_micros((F.col(axis) if isinstance(axis, str) else axis).cast("timestamp_ltz"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def div(value: Column, divisor: Column | int) -> Column:
    """Exact integer quotient, truncated toward zero (no detour over doubles)."""
    return F.call_function("div", value, F.lit(divisor))


def floor_to(value: Column, width: int) -> Column:
    """The largest multiple of *width* not above *value*, also before 1970."""
    return value - F.pmod(value, F.lit(width))


def shard_of(axis: Column | str, width: int) -> Column:
    """Shard number: ``floor(micros / width)``."""
    return div(floor_to(micros(axis), width), width)
