"""Text to typed values and back, as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE, _REAL = "[+-]?[0-9]+", "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[+-]?(NaN|Infinity)"
_DAY = "[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"
_INSTANT = _DAY + "[T ].+"

#: What text of a type looks like; the casts themselves would take more, such as a year for a date.
_FORMS = {
    T.ByteType: _WHOLE,
    T.ShortType: _WHOLE,
    T.IntegerType: _WHOLE,
    T.LongType: _WHOLE,
    T.FloatType: _REAL,
    T.DoubleType: _REAL,
    T.DateType: _DAY,
    T.TimestampType: _INSTANT,
    T.TimestampNTZType: _INSTANT,
}


def parse_text(text: Column, data_type: T.DataType, name: str) -> Column:
    """Typed value of ``text``.

    Null stays null; a value that does not parse is an error naming the value,
    the type and the column, under any ``spark.sql.ansi.enabled``. Space around a
    value, a date or time that is cut short, and digits behind those of a decimal's
    scale are not taken.
    """
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.BooleanType):
        lowered = F.lower(text)
        parsed = F.when(lowered == "true", F.lit(True)).when(lowered == "false", F.lit(False))
    elif isinstance(data_type, T.DecimalType):
        plain = F.regexp_replace(text, ",", "")
        fits = plain.rlike(f"^[+-]?([0-9]+([.][0-9]{{0,{data_type.scale}}}0*)?|[.][0-9]{{1,{max(1, data_type.scale)}}}0*)$")
        parsed = F.when(fits, plain.try_cast(data_type))
    elif type(data_type) in _FORMS:
        parsed = F.when(text.rlike(f"^({_FORMS[type(data_type)]})$"), text.try_cast(data_type))
    else:
        raise ValueError(f"Column '{name}': cannot parse text as {data_type.simpleString()}")
    message = F.concat(
        F.lit("Cannot parse '"),
        text,
        F.lit(f"' as {data_type.simpleString()} in column '{name}'"),
    )
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(F.raise_error(message))


def parse_iso_timestamp(text: Column, truncate_seconds: bool = False) -> Column:
    """ISO-8601 text to a timestamp; microseconds are kept unless truncated."""
    parsed = text.cast(T.TimestampType())
    return F.date_trunc("second", parsed) if truncate_seconds else parsed


def utc_clock(instant: Column) -> Column:
    """The UTC date and time of a ``timestamp`` as ``timestamp_ntz``, whatever the
    time zone of the session."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") * F.expr("0.000001BD")).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def format_iso_timestamp(value: Column) -> Column:
    """Timestamp to ISO-8601 text with milliseconds and a ``Z``.

    Takes ``timestamp_ntz``, in any session time zone; put a ``timestamp`` through
    :func:`utc_clock` first, unless that zone is UTC.
    """
    text = value.cast("string")
    clock = F.substring_index(text, " ", -1)
    fraction = F.when(F.instr(clock, ".") > 0, F.substring_index(clock, ".", -1)).otherwise("")
    millis = F.rpad(F.substring(fraction, 1, 3), 3, "0")
    day, seconds = F.substring_index(text, " ", 1), F.substring_index(clock, ".", 1)
    return F.concat(day, F.lit("T"), seconds, F.lit("."), millis, F.lit("Z"))
