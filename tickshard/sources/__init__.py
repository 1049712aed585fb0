from tickshard.sources.local import from_pandas
from tickshard.sources.query import empty_result, query, result_schema
from tickshard.sources.ranges import read_ranges, read_request, read_slices, read_table

__all__ = [
    "empty_result",
    "from_pandas",
    "query",
    "read_ranges",
    "read_request",
    "read_slices",
    "read_table",
    "result_schema",
]
