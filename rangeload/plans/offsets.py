"""Offset columns: types, literals and arithmetic.

An offset value is handled on the driver as one plain *unit*:

========== =======================================
integer    int
decimal    int, the unscaled value
timestamp  int, microseconds since 1970-01-01 UTC
date       int, days since 1970-01-01
double     float
string     str
========== =======================================
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = datetime(1970, 1, 1)
_EPOCH_DAY = date(1970, 1, 1)
_MICRO = timedelta(microseconds=1)
_WIDE = Context(prec=60)

# A wider span could overflow a bigint subtraction.
_SAFE_SPAN = 1 << 62

# Bytes of text that fit a double without rounding.
_TEXT_BYTES = 6

_KINDS = {
    T.ByteType: "integer",
    T.ShortType: "integer",
    T.IntegerType: "integer",
    T.LongType: "integer",
    T.DecimalType: "decimal",
    T.TimestampType: "timestamp",
    T.TimestampNTZType: "timestamp",
    T.DateType: "date",
    T.FloatType: "double",
    T.DoubleType: "double",
    T.StringType: "string",
}


@dataclass(frozen=True)
class OffsetType:
    """Arithmetic of one offset column."""

    data_type: T.DataType

    def __post_init__(self):
        if type(self.data_type) not in _KINDS:
            raise ValueError(f"A column of type {self.data_type.simpleString()} cannot be an offset")

    @classmethod
    def of(cls, df: DataFrame, column: str) -> OffsetType:
        for field in df.schema:
            if field.name.lower() == column.lower():
                return cls(field.dataType)
        raise ValueError(f"No offset column '{column}'. Available columns: {', '.join(df.columns)}")

    @property
    def kind(self) -> str:
        return _KINDS[type(self.data_type)]

    @property
    def splittable(self) -> bool:
        """Text has no arithmetic and stays one range."""
        return self.kind != "string"

    # -- driver values ---------------------------------------------------

    def parse(self, value):
        """Unit of a user's bound or of text from a state file."""
        try:
            return self._parse(value)
        except (ValueError, ArithmeticError, TypeError):
            raise ValueError(f"Cannot parse '{value}' as an offset of type {self.data_type.simpleString()}") from None

    def _parse(self, value):
        if self.kind == "string":
            return str(value)
        if isinstance(value, bool):
            raise TypeError
        if self.kind == "integer":
            if isinstance(value, float) and not value.is_integer():
                raise ValueError
            return int(value)
        if self.kind == "double":
            number = float(value)
            if math.isnan(number):
                raise ValueError
            return number
        if self.kind == "decimal":
            scaled = Decimal(value).scaleb(self.data_type.scale, _WIDE)
            if scaled != scaled.to_integral_value(context=_WIDE):
                raise ValueError
            return int(scaled)
        if self.kind == "date":
            if isinstance(value, datetime):
                raise TypeError
            day = value if isinstance(value, date) else date.fromisoformat(value)
            return (day - _EPOCH_DAY).days
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(value)
        if moment.tzinfo is not None:
            moment = moment.astimezone(UTC).replace(tzinfo=None)
        return (moment - _EPOCH) // _MICRO

    def to_python(self, unit):
        """The value a DataFrame row would hold; timestamps are naive UTC."""
        if unit is None:
            return None
        if self.kind == "decimal":
            return Decimal(unit).scaleb(-self.data_type.scale, _WIDE)
        if self.kind == "date":
            return _EPOCH_DAY + timedelta(days=unit)
        if self.kind == "timestamp":
            return _EPOCH + timedelta(microseconds=unit)
        return unit

    def to_text(self, unit) -> str | None:
        """Readable form that :meth:`parse` takes back unchanged."""
        if unit is None:
            return None
        if self.kind == "timestamp":
            text = self.to_python(unit).isoformat(timespec="microseconds")
            return text + ("Z" if isinstance(self.data_type, T.TimestampType) else "")
        if self.kind == "date":
            return self.to_python(unit).isoformat()
        return repr(unit) if self.kind == "double" else str(self.to_python(unit))

    def collected(self, value):
        """Unit of a value collected through :meth:`collectable`."""
        if value is None or self.kind in ("integer", "timestamp", "date", "string"):
            return value
        return self.parse(value)

    # -- column expressions ----------------------------------------------

    def sql(self, unit) -> str:
        """Typed literal as SQL; it folds to a constant that scans can push down."""
        if self.kind == "string":
            return f"CAST(X'{unit.encode().hex()}' AS STRING)"
        return f"CAST('{self.to_text(unit)}' AS {self.data_type.simpleString()})"

    def literal(self, unit) -> Column:
        return F.expr(self.sql(unit))

    def usable(self, column: Column) -> Column:
        """The column with NaN as null, since NaN has no place in a range."""
        return F.when(~F.isnan(column), column) if self.kind == "double" else column

    def collectable(self, name: str) -> Column:
        """A form that is collected without any time zone conversion."""
        return F.expr(self._collectable(name))

    def _collectable(self, name: str) -> str:
        column = quoted(name)
        if isinstance(self.data_type, T.TimestampType):
            return f"unix_micros({column})"
        if isinstance(self.data_type, T.TimestampNTZType):
            return (
                f"unix_date(CAST({column} AS DATE)) * 86400000000L + hour({column}) * 3600000000L"
                f" + minute({column}) * 60000000L + CAST(extract(SECOND FROM {column}) * 1000000 AS BIGINT)"
            )
        return f"unix_date({column})" if self.kind == "date" else column

    def number(self, name: str) -> str | None:
        """SQL of the column's unit as a bigint, or a double for a double; None if it fits neither."""
        if self.kind == "string" or (self.kind == "decimal" and self.data_type.precision > 18):
            return None
        if self.kind == "decimal":
            return f"CAST({quoted(name)} * {10**self.data_type.scale} AS BIGINT)"
        return f"CAST({self._collectable(name)} AS {'DOUBLE' if self.kind == 'double' else 'BIGINT'})"

    def within(self, name: str, spans: list[tuple], which: str) -> str:
        """SQL of where a column lies inside ``spans[which]``, from 0 to 1.

        ``spans`` are (low, high) pairs with low < high. The position never falls
        when the column grows, which is all that bucketing needs.
        """
        if self.kind == "string":
            return self._text_within(name, spans, which)
        lows = [low for low, _ in spans]
        if self.kind == "decimal":
            widths = [(high - low) / 10**self.data_type.scale for low, high in spans]
            low = _item([self.sql(low) for low in lows], which)
            column = quoted(name)
            if self.data_type.precision < 38:
                distance = f"CAST({column} - {low} AS DOUBLE)"
            else:
                distance = f"(CAST({column} AS DOUBLE) - CAST({low} AS DOUBLE))"
        else:
            if self.kind == "double":
                # halves of finite values, so that no difference is infinite
                halves = [(finite(low) / 2, finite(high) / 2) for low, high in spans]
                value = f"greatest(least(CAST({quoted(name)} AS DOUBLE), {_double(LARGEST)}), {_double(-LARGEST)})"
                low = _item([_double(low) for low, _ in halves], which)
                # infinity and the largest number are one place
                width = _item([_double((high - low) or 1.0) for low, high in halves], which)
                return f"({value} / 2 - {low}) / {width}"
            widths = [float(high - low) for low, high in spans]
            value = self._collectable(name)
            if max(high - low for low, high in spans) >= _SAFE_SPAN:
                distance = f"(CAST({value} AS DOUBLE) - {_item([_double(low) for low in lows], which)})"
            else:
                distance = f"CAST({value} - {_item([f'{low}L' for low in lows], which)} AS DOUBLE)"
        return f"{distance} / {_item([_double(width) for width in widths], which)}"

    def _text_within(self, name: str, spans: list[tuple], which: str) -> str:
        starts, lows, widths = [], [], []
        for low, high in spans:
            a, b = low.encode(), high.encode()
            start = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            first, last = (
                float(int.from_bytes(text[start : start + _TEXT_BYTES].ljust(_TEXT_BYTES, b"\0"))) for text in (a, b)
            )
            starts.append(str(start + 1))
            lows.append(_double(first))
            widths.append(_double(max(last - first, 1.0)))
        part = f"substring(CAST({quoted(name)} AS BINARY), {_item(starts, which)}, {_TEXT_BYTES})"
        number = f"CAST(conv(rpad(hex({part}), {2 * _TEXT_BYTES}, '0'), 16, 10) AS DOUBLE)"
        return f"({number} - {_item(lows, which)}) / {_item(widths, which)}"


#: The largest finite double.
LARGEST = sys.float_info.max


def finite(number: float) -> float:
    """The number, or the finite one next to an infinity."""
    return max(-LARGEST, min(LARGEST, number))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _double(number: float) -> str:
    return f"CAST('{float(number)!r}' AS DOUBLE)"


def _item(literals: list[str], which: str) -> str:
    """The literal at position ``which``; a lone one needs no lookup."""
    return literals[0] if len(literals) == 1 else f"array({', '.join(literals)})[{which}]"
