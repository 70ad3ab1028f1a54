"""A key that spreads equal rows over tasks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_key(df: DataFrame) -> Column:
    """A bigint that differs between rows, also between copies of one row that
    different tasks read.

    A task that runs again gives every row the same key, which random numbers would
    not. Rows of files are told apart by their place in the file, so that no column
    is read for the key; others by all they hold.
    """
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    try:
        df.select(place)
        return place
    except AnalysisException:  # no scan of Parquet files
        pass
    hashable = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{name}`") for name in hashable])
