from tickshard.functions.clock import (
    floor_to,
    from_micros,
    instant_micros,
    micros,
    require_utc,
    shard_of,
    width_micros,
)
from tickshard.functions.missing import nan_to_null, null_if_nan

__all__ = [
    "floor_to",
    "from_micros",
    "instant_micros",
    "micros",
    "nan_to_null",
    "null_if_nan",
    "require_utc",
    "shard_of",
    "width_micros",
]
