"""Reserved column names. A leading ``$`` marks bookkeeping, not user data."""

AXIS = "$timestamp"  # the time axis every table has
SHARD = "$shard"  # partition column of stored tables: floor(axis / width)
GEN = "$gen"  # partition column of stored tables: the write that stored a row
TABLE = "$table"  # source table name some result frames carry
SLICE = "$slice"  # slice number while a result is cut in time


def is_internal(name: str) -> bool:
    return name.startswith("$") and name != AXIS


def quoted_column(name: str) -> str:
    """*name* as one SQL identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"
