"""Predicates on a scan."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def all_of(conditions: Iterable[Column | str | None]) -> Column | None:
    """Conjunction of the given conditions, or None when there is none."""
    columns = [as_column(c) for c in conditions if c is not None]
    return reduce(lambda a, b: a & b, columns) if columns else None


def apply_filters(df: DataFrame, *filters: Column | str) -> DataFrame:
    """Rows that meet every filter.

    Catalyst pushes what the source can use into the scan and keeps the rest,
    so values need no quoting and nothing is refused.
    """
    condition = all_of(filters)
    return df if condition is None else df.where(condition)
