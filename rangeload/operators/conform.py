"""Fitting a table to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared order; absent ones are null.

    A column that is present must already have the declared type.
    """
    present = {field.name.lower(): field for field in df.schema}
    columns = []
    for field in schema:
        found = present.get(field.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        if found.dataType != field.dataType:
            raise ValueError(
                f"Column '{field.name}': declared {field.dataType.simpleString()}, "
                f"the table has {found.dataType.simpleString()}"
            )
        columns.append(F.col(found.name).alias(field.name))
    return df.select(*columns)


# The numeric types from narrow to wide.
_NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` is one of ``wanted``, as records take them."""
    if found == wanted or isinstance(found, T.NullType):
        return True
    if isinstance(wanted, T.StringType):
        return isinstance(found, T.AtomicType)
    if isinstance(wanted, T.DecimalType):
        digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
        if isinstance(found, T.DecimalType):
            return found.scale <= wanted.scale and found.precision - found.scale <= wanted.precision - wanted.scale
        return digits.get(type(found), 99) <= wanted.precision - wanted.scale
    if type(found) in _NUMBERS and type(wanted) in _NUMBERS:
        return _NUMBERS.index(type(found)) < _NUMBERS.index(type(wanted))
    return isinstance(found, T.DateType) and isinstance(wanted, (T.TimestampType, T.TimestampNTZType))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows as records of ``schema``: matched by name, every field must exist.

    Types may only widen, and a null in a field that is declared not nullable is an error.
    """
    present = {name.lower() for name in df.columns}
    missing = [field.name for field in schema if field.name.lower() not in present]
    if missing:
        raise ValueError(f"Missing columns {missing}. Available columns: {', '.join(df.columns)}")
    types = {field.name.lower(): field.dataType for field in df.schema}
    columns = []
    for field in schema:
        found, value = types[field.name.lower()], F.col(f"`{field.name}`")
        if not widens(found, field.dataType):
            raise ValueError(f"Column '{field.name}': {found.simpleString()} does not fit into {field.dataType.simpleString()}")
        value = value.cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"Null in column '{field.name}', which is declared without")).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(columns)


def drop_compound(df: DataFrame) -> DataFrame:
    """Only the columns of simple types."""
    compound = (T.StructType, T.ArrayType, T.MapType)
    return df.select([field.name for field in df.schema if not isinstance(field.dataType, compound)])
