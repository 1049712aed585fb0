"""Time-series tables on Spark: query, slice, aggregate, join as of, and write."""

from tickshard.functions import nan_to_null
from tickshard.names import AXIS
from tickshard.operators import (
    asof_join,
    bucket_agg,
    bucket_count,
    bucket_filled,
    counted_within,
    declare_schema,
    global_stats,
    hide_internal,
    lagged,
    led,
    normalize_axis,
    numbered,
    partition_by_slice,
    ranked,
    rolled_within,
    slice_bounds,
    tiled,
    time_range,
    with_global_stats,
    with_slice,
)
from tickshard.plans.snapshots import (
    ConcurrentWriteError,
    compact_table,
    index_keys,
    measure_columns,
    remove_replaced,
    stored_stats,
)
from tickshard.plans.snapshots import drop as drop_table
from tickshard.plans.temporary import expire_temp, materialize
from tickshard.sinks import PendingWrite, write_dataframe
from tickshard.sources import (
    empty_result,
    from_pandas,
    query,
    read_ranges,
    read_request,
    read_slices,
    read_table,
    result_schema,
)
from tickshard.streaming import write_stream

__all__ = [
    "AXIS",
    "ConcurrentWriteError",
    "PendingWrite",
    "asof_join",
    "bucket_agg",
    "bucket_count",
    "bucket_filled",
    "compact_table",
    "counted_within",
    "declare_schema",
    "drop_table",
    "empty_result",
    "expire_temp",
    "from_pandas",
    "global_stats",
    "hide_internal",
    "index_keys",
    "lagged",
    "led",
    "materialize",
    "measure_columns",
    "nan_to_null",
    "normalize_axis",
    "numbered",
    "partition_by_slice",
    "query",
    "ranked",
    "read_ranges",
    "read_request",
    "read_slices",
    "read_table",
    "remove_replaced",
    "result_schema",
    "rolled_within",
    "slice_bounds",
    "stored_stats",
    "tiled",
    "time_range",
    "with_global_stats",
    "with_slice",
    "write_dataframe",
    "write_stream",
]
