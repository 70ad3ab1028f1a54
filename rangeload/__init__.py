"""Offset-range loading of tables with PySpark DataFrames."""

from rangeload.operators.conform import apply_schema, conform, drop_compound
from rangeload.operators.filters import apply_filters
from rangeload.operators.ordering import order_output, top_k
from rangeload.operators.ranges import (
    RangeScan,
    quantile_ranges,
    range_scan,
    ranges_frame,
)
from rangeload.operators.replay import drop_replayed, replay_from
from rangeload.operators.scan import scan
from rangeload.operators.stats import count_new, offset_stats
from rangeload.options import LoadOptions
from rangeload.plans.bounds import (
    OffsetRange,
    rebuild_ranges,
    recreate_ranges,
    split_range,
)
from rangeload.plans.offsets import OffsetType
from rangeload.session import scratch_dir, spark_session
from rangeload.sources.tables import describe, load, typed_load
from rangeload.streaming.incremental import IncrementalLoader

__all__ = [
    "IncrementalLoader",
    "LoadOptions",
    "OffsetRange",
    "OffsetType",
    "RangeScan",
    "apply_filters",
    "apply_schema",
    "conform",
    "count_new",
    "describe",
    "drop_compound",
    "drop_replayed",
    "load",
    "offset_stats",
    "order_output",
    "quantile_ranges",
    "range_scan",
    "ranges_frame",
    "rebuild_ranges",
    "recreate_ranges",
    "replay_from",
    "scan",
    "scratch_dir",
    "spark_session",
    "split_range",
    "top_k",
    "typed_load",
]
