"""Small frames the tests share."""

import numpy as np
import pandas as pd

# Dtypes of the value column in the write matrix.
DTYPES = ("int64", "int32", "int16", "float64", "float32", "datetime64[ns]", "str", "bytes")
MORE_DTYPES = ("float16", "datetime64[ms]", "datetime64[s]", "object")


def values(dtype, n, rng):
    if dtype.startswith("int"):
        return pd.Series(rng.integers(-100, 100, n).astype(dtype))
    if dtype.startswith("float"):
        return pd.Series(rng.uniform(-100, 100, n).astype(dtype))
    if dtype.startswith("datetime64"):
        seconds = pd.date_range("2017-01-01", periods=n, freq="s")
        return pd.Series(seconds.to_numpy().astype(dtype))
    if dtype == "str":
        letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0x3B1, 0x3C9), *range(0x16A0, 0x16C0))]
        words = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(n)]
        return pd.Series(words, dtype=object)
    texts = [repr(v) for v in rng.uniform(0, 100, n)]
    if dtype == "bytes":
        return pd.Series([t.encode() for t in texts], dtype=object)
    return pd.Series(texts, dtype=object)


def hourly(dtype, rows, missing):
    """Hourly rows with one value column; *missing* of 0, 0.5 or 1 of its values are missing."""
    rng = np.random.default_rng(rows * 31 + int(missing * 7))
    column = values(dtype, rows, rng)
    if missing:
        gone = rng.random(rows) < missing
        if dtype.startswith("int"):
            column = column.astype(dtype.capitalize())
        column = column.mask(gone, None if column.dtype == object else pd.NA)
    index = pd.date_range("2017-01-01", periods=rows, freq="h", name="$timestamp")
    return pd.DataFrame({"x": column.to_numpy() if column.dtype == object else column.array},
                        index=index)
