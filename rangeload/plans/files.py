"""First and last offset of each file of a table.

A step of a load needs a narrow slice of the offsets. Row groups are skipped by
their statistics, but only after a task has opened the file. With the offsets of
every file at hand the scan is planned over the files that can hold the slice.
"""

from __future__ import annotations

import bisect
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeload.operators.filters import as_column
from rangeload.operators.stats import OffsetStats
from rangeload.plans.bounds import OffsetRange
from rangeload.plans.offsets import OffsetType

class FileOffsets:
    """Offsets per file, kept as a small written table."""

    def __init__(self, table: DataFrame, kind: OffsetType):
        self._table = table
        self._kind = kind
        self._all: list[tuple] | None = None
        self._ends: tuple[list, list] | None = None

    @classmethod
    def collect(
        cls,
        df: DataFrame,
        offset: str,
        path: str,
        where: Column | str | None = None,
        known: Mapping[str, int] | None = None,
    ) -> FileOffsets | None:
        """One pass over the offset column; None if ``df`` is no scan of files.

        ``where`` only narrows which rows are counted. Files that are ``known``, by
        name and time of change, are not opened.
        """
        kind = OffsetType.of(df, offset)
        try:
            changed = F.unix_micros("_metadata.file_modification_time")
            if known:
                named = F.concat(F.col("_metadata.file_path"), F.lit("|"), changed.cast("string"))
                df = df.where(~named.isin([f"{name}|{at}" for name, at in known.items()]))
            files = df.withColumn("__file", F.col("_metadata.file_path")).withColumn("__changed", changed)
        except AnalysisException:
            return None
        column = kind.usable(F.col(offset))
        matches = F.lit(True) if where is None else as_column(where)
        per_file = files.groupBy("__file", "__changed").agg(
            F.min(column).alias("first"),
            F.max(column).alias("last"),
            F.count_if(matches & column.isNotNull()).alias("rows"),
            F.count_if(matches & column.isNull()).alias("without_offset"),
        )
        per_file.write.mode("overwrite").parquet(path)
        return cls(df.sparkSession.read.schema(per_file.schema).parquet(path), kind)

    @classmethod
    def written(cls, spark: SparkSession, path: str, kind: OffsetType) -> FileOffsets:
        """What :meth:`collect` has written to ``path``."""
        return cls(spark.read.parquet(path), kind)

    def stats(self) -> OffsetStats:
        """The same as a pass over the table itself would give."""
        row = self._table.agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("without_offset"), F.lit(0)).alias("without_offset"),
        )
        row = row.select(
            self._kind.collectable("first").alias("first"),
            self._kind.collectable("last").alias("last"),
            "rows",
            "without_offset",
        ).first()
        return OffsetStats(
            self._kind.collected(row["first"]), self._kind.collected(row["last"]), row.rows, row.without_offset
        )

    def narrow(self, df: DataFrame, spans: list[OffsetRange]) -> DataFrame:
        """``df`` without the files that hold none of the spans."""
        return df.where(F.col("_metadata.file_path").isin(self.overlapping(spans)))

    def names(self) -> dict[str, int]:
        """Each file with its time of change."""
        return {row[0]: row[1] for row in self._table.select("__file", "__changed").collect()}

    def count(self) -> int:
        return len(self._listed())

    def many_overlapping(self, lower, upper) -> int:
        """How many files can hold offsets from ``lower`` to ``upper``."""
        if self._ends is None:
            self._ends = (sorted(first for _, first, _ in self._listed()), sorted(last for _, _, last in self._listed()))
        firsts, lasts = self._ends
        return bisect.bisect_right(firsts, upper) - bisect.bisect_left(lasts, lower)

    def overlapping(self, spans: list[OffsetRange]) -> list[str]:
        """Files that can hold any of the spans: a part of the listing the driver plans scans from."""
        return [name for name, first, last in self._listed() if any(first <= s.upper and last >= s.lower for s in spans)]

    def _listed(self) -> list[tuple]:
        """Name, first and last offset of each file that has any."""
        if self._all is None:
            rows = self._table.where("first IS NOT NULL").select(
                "__file", self._kind.collectable("first").alias("first"), self._kind.collectable("last").alias("last")
            )
            self._all = [(r[0], self._kind.collected(r[1]), self._kind.collected(r[2])) for r in rows.collect()]
        return self._all
