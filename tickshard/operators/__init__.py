from tickshard.operators.asof import asof_join
from tickshard.operators.axis import normalize_axis, time_range
from tickshard.operators.buckets import bucket_agg, bucket_count, bucket_filled
from tickshard.operators.running import (
    counted_within,
    lagged,
    led,
    numbered,
    ranked,
    rolled_within,
    tiled,
)
from tickshard.operators.schema import coerce, declare_schema, hide_internal, stored_schema
from tickshard.operators.slices import partition_by_slice, slice_bounds, with_slice
from tickshard.operators.stats import global_stats, with_global_stats

__all__ = [
    "asof_join",
    "bucket_agg",
    "bucket_count",
    "bucket_filled",
    "coerce",
    "counted_within",
    "declare_schema",
    "global_stats",
    "hide_internal",
    "lagged",
    "led",
    "normalize_axis",
    "numbered",
    "partition_by_slice",
    "ranked",
    "rolled_within",
    "slice_bounds",
    "stored_schema",
    "tiled",
    "time_range",
    "with_global_stats",
    "with_slice",
]
