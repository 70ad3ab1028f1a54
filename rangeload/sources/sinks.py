"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Time formats that keep microseconds in text sinks.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    **TEXT_TIMES,
}


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header. Empty text comes back as null, which CSV cannot tell apart."""
    df.write.mode(mode).options(**_CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV written by :func:`write_csv`, read with a declared schema.

    Values with line breaks need ``multi_line``, which reads each file in one task.
    """
    return spark.read.schema(schema).options(multiLine=multi_line, mode="FAILFAST", **_CSV).csv(path)
