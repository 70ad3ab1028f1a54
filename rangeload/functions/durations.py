"""Readable durations as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit suffix and its length in milliseconds.
UNITS = {
    "d": 86_400_000,
    "h": 3_600_000,
    "min": 60_000,
    "sec": 1_000,
    "millis": 1,
}


def format_duration(millis: Column, units: tuple[str, ...] = ("d", "h", "min", "sec", "millis")) -> Column:
    """Milliseconds as text such as ``23d 3h 33min 51sec 7millis``.

    ``units`` are neighbours, largest first. The largest unit is not wrapped,
    leading units of zero are left out and the last unit is always there.
    """
    names = list(UNITS)
    start = names.index(units[0]) if units and units[0] in names else 0
    if not units or list(units) != names[start : start + len(units)]:
        raise ValueError(f"units must be neighbours in {names}, largest first: {units}")
    parts = []
    for position, unit in enumerate(units):
        size = UNITS[unit]
        amount = F.floor(millis / F.lit(size))
        if position:
            amount = amount % F.lit(UNITS[units[position - 1]] // size)
        text = F.concat(amount.cast("string"), F.lit(unit))
        last = position == len(units) - 1
        parts.append(text if last else F.when(millis >= size, text))
    return F.concat_ws(" ", *parts)
