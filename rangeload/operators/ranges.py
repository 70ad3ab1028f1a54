"""Range-partitioned scans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.functions.spread import spread_key
from rangeload.operators.filters import apply_filters
from rangeload.operators.stats import offset_stats
from rangeload.plans.bounds import (
    OffsetRange,
    predicate_over,
    ranges_from_edges,
    split_range,
    with_count,
    with_index,
)
from rangeload.plans.histogram import quantile_cuts, sketched_cuts
from rangeload.plans.offsets import OffsetType


@dataclass(frozen=True)
class RangeScan:
    """Rows of a table by offset range."""

    df: DataFrame
    offset: str
    ranges: list[OffsetRange]

    @property
    def kind(self) -> OffsetType:
        return OffsetType.of(self.df, self.offset)

    def rows(self, range_id: str = "range_id") -> DataFrame:
        """Rows inside the ranges, each with the id of its range.

        One scan with the outer bounds pushed down and no shuffle: the id is an
        expression, and file splits, not ranges, decide the tasks. A range with
        most of the rows is therefore read by most of the tasks.
        """
        if range_id.lower() in {c.lower() for c in self.df.columns}:
            raise ValueError(f"The table has a column '{range_id}'; choose another name for the range id")
        if not self.ranges:
            return self.df.where(F.lit(False)).withColumn(range_id, F.lit(0))
        inside = self.df.where(predicate_over(self.offset, self.ranges, self.kind))
        return with_index(inside, range_id, self.offset, [r.lower for r in self.ranges], self.kind)

    def ordered(self, partitions: int | None = None, range_id: str = "range_id") -> DataFrame:
        """Rows in offset order, within each range and across tasks.

        The edges of the tasks come from a histogram of the offset column, which
        is read alone for it, so the full rows are read just once. Rows that
        share one frequent offset spread over all tasks that end or start there,
        so no task gets more than about two even shares. ``partitions`` is their number;
        if not given, it follows from the size of the scan.
        """
        rows = self.rows(range_id)
        if not self.ranges:
            return rows
        n = partitions or tasks_for(rows)
        first, last = self.ranges[0], self.ranges[-1]
        whole = OffsetRange(0, first.lower, last.upper, first.lo_op, last.hi_op)
        cuts = quantile_cuts(rows, self.offset, whole, n, tolerance=0.1 / n)
        placed = with_count(rows, "__lowest", self.offset, cuts, self.kind, inclusive=False)
        placed = with_count(placed, "__highest", self.offset, cuts, self.kind, inclusive=True)
        choices = F.col("__highest") - F.col("__lowest") + 1
        task = (F.col("__lowest") + F.pmod(spread_key(rows), choices)).cast("int")
        return placed.repartitionById(n, task).drop("__lowest", "__highest").sortWithinPartitions(self.offset)

    def frame(self, spark: SparkSession) -> DataFrame:
        return ranges_frame(spark, self.ranges, self.kind)

    def progress(self) -> DataFrame:
        """Rows and last offset per range; empty ranges are there with zero rows."""
        spark = self.df.sparkSession
        counted = self.rows("__range").groupBy(F.col("__range").alias("range_id")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(self.offset).alias("last_offset")
        )
        named = self.frame(spark).select("range_id", "lower", "upper")
        # One row per range on either side, so the broadcast is bounded.
        return named.join(F.broadcast(counted), "range_id", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))


def range_scan(
    df: DataFrame,
    offset: str,
    n: int = 1,
    lower=None,
    upper=None,
    where: Column | str | Sequence[Column | str] = (),
) -> RangeScan:
    """Split the table into ``n`` equal-width ranges of its offset column.

    Bounds that are not given are looked up in one pass over that column. They
    are those of the whole table, while ``where`` narrows only the rows.
    """
    kind = OffsetType.of(df, offset)
    low = None if lower is None else kind.parse(lower)
    high = None if upper is None else kind.parse(upper)
    if low is None or high is None:
        stats = offset_stats(df, offset)
        low = stats.first if low is None else low
        high = stats.last if high is None else high
    filters = [where] if isinstance(where, (Column, str)) else list(where)
    rows = apply_filters(df, *filters)
    if low is None or high is None:
        return RangeScan(rows, offset, [])
    return RangeScan(rows, offset, split_range(low, high, n, kind))


def quantile_ranges(
    df: DataFrame,
    offset: str,
    n: int,
    where: Column | str | Sequence[Column | str] = (),
    tolerance: float | None = None,
) -> RangeScan:
    """Ranges that hold about equally many rows, for skewed offsets.

    ``tolerance`` is the share of all rows by which an edge may be off; a twentieth of
    an even range if not given, which takes a single pass that merges sketches (text, wide decimals, and
    thousands of ranges are counted in histograms instead). Zero is exact. Fewer than ``n`` come back when single values hold more than their share.
    """
    filters = [where] if isinstance(where, (Column, str)) else list(where)
    rows = apply_filters(df, *filters)
    tolerance = 0.05 / n if tolerance is None else tolerance
    found = sketched_cuts(rows, offset, n, tolerance)
    if found is None:
        stats = offset_stats(rows, offset)
        found = stats.first, stats.last, []
        if stats.first is not None:
            found = stats.first, stats.last, quantile_cuts(rows, offset, OffsetRange(0, stats.first, stats.last), n, tolerance)
    first, last, cuts = found
    return RangeScan(rows, offset, [] if first is None else ranges_from_edges([first, *cuts, last]))


# Fixed value: about what one task sorts in memory.
BYTES_OF_TASK = 256 << 20


def tasks_for(df: DataFrame) -> int:
    """Tasks for a shuffle of all of ``df``: the session's number, more if its scan is large."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size < 1 << 60  # else a guess for a source that does not tell
    return max(least, -(-size // BYTES_OF_TASK)) if known else least


def ranges_frame(spark: SparkSession, ranges: Sequence[OffsetRange], kind: OffsetType) -> DataFrame:
    """The ranges as a DataFrame; bounds have the type of the offset column."""
    rows = [f"({r.id}, {kind.sql(r.lower)}, {kind.sql(r.upper)}, '{r.lo_op}', '{r.hi_op}')" for r in ranges]
    none = f"(0, CAST(NULL AS {kind.data_type.simpleString()}), CAST(NULL AS {kind.data_type.simpleString()}), '', '')"
    frame = spark.sql(
        f"SELECT * FROM VALUES {', '.join(rows or [none])} AS ranges(range_id, lower, upper, lo_op, hi_op)"
    )
    return frame if rows else frame.where(F.lit(False))
