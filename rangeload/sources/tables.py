"""Table sources: by query, by name, by path, and typed loads from text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeload.functions.casts import parse_text

# Source type names and the Spark types they load as. Every other
# name, unknown ones too, loads as a string.
SOURCE_TYPES = {
    "datetime": T.TimestampType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def load(spark: SparkSession, query: str | None) -> DataFrame:
    """One query or one bare table name; a name loads the whole table."""
    if not isinstance(query, str) or not query.strip():
        raise ValueError("A query or a table name is required")
    text = query.strip().rstrip(";")
    return spark.sql(text) if len(text.split()) > 1 else spark.table(text)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A table stored as files; pass ``schema`` to skip schema inference."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type name) in table order."""
    return [(field.name, field.dataType.simpleString()) for field in df.schema]


def declared_schema(columns: list[tuple[str, str]], key: str | None = None) -> T.StructType:
    """Schema of (column, source type name) pairs; only ``key`` is not nullable."""
    return T.StructType(
        [
            T.StructField(name, SOURCE_TYPES.get(kind, T.StringType()), nullable=name != key)
            for name, kind in columns
        ]
    )


def typed_load(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns as the declared types, in one projection.

    A declared column the table lacks is null; bad text is an error.
    """
    present = {name.lower(): name for name in df.columns}
    return df.select(
        [
            (
                parse_text(F.col(present[field.name.lower()]), field.dataType, field.name)
                if field.name.lower() in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema
        ]
    )
