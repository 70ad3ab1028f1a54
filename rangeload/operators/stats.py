"""First and last offsets and row counts, one pass each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.operators.filters import as_column
from rangeload.plans.offsets import OffsetType


@dataclass(frozen=True)
class OffsetStats:
    """Offsets as units; ``rows`` counts those that match and have an offset."""

    first: object
    last: object
    rows: int
    without_offset: int


def offset_stats(df: DataFrame, offset: str, where: Column | str | None = None) -> OffsetStats:
    """First and last offset of the whole table, and how many rows match ``where``."""
    kind = OffsetType.of(df, offset)
    column = kind.usable(F.col(offset))
    matches = F.lit(True) if where is None else as_column(where)
    row = (
        df.agg(
            F.min(column).alias("first"),
            F.max(column).alias("last"),
            F.count_if(matches & column.isNotNull()).alias("rows"),
            F.count_if(matches & column.isNull()).alias("without_offset"),
        )
        .select(
            kind.collectable("first").alias("first"),
            kind.collectable("last").alias("last"),
            "rows",
            "without_offset",
        )
        .first()
    )
    return OffsetStats(kind.collected(row["first"]), kind.collected(row["last"]), row.rows, row.without_offset)


def first_last(df: DataFrame, offset: str) -> DataFrame:
    """One row with the first and the last offset, as a plan."""
    column = OffsetType.of(df, offset).usable(F.col(offset))
    return df.agg(F.min(column).alias("first_offset"), F.max(column).alias("last_offset"))


def first_last_of_files(spark: SparkSession, path: str, offset: str) -> DataFrame:
    """The same for the Parquet files in ``path``, from their footers where these have it.

    They have exact ends of integers and dates, so no row is read for these; text is cut short there, a NaN may hide
    the ends of doubles, and for timestamps the reader does not ask, so the column of these is read. The
    plan belongs to a session of its own, in which the reader may answer from footers.
    """
    files = spark.read.parquet(path)
    if OffsetType.of(files, offset).kind not in ("integer", "date"):
        return first_last(files, offset)
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return first_last(session.read.parquet(path), offset)


def count_new(df: DataFrame, offset: str, after, where: Column | str | None = None) -> DataFrame:
    """One row: matching rows past ``after`` and the last offset of the table.

    The bound is a filter, so a scan skips everything at or below it.
    """
    kind = OffsetType.of(df, offset)
    rows = df if after is None else df.where(F.col(offset) > kind.literal(after))
    column = kind.usable(F.col(offset))
    matches = F.lit(True) if where is None else as_column(where)
    return rows.agg(
        F.count_if(matches & column.isNotNull()).alias("new_rows"),
        F.max(column).alias("last_offset"),
    )
