"""Output order and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeload.functions.spread import spread_key


def order_output(df: DataFrame, order: Sequence[Column | str], offset: str) -> DataFrame:
    """The user's order with the offset column behind it.

    A last key spreads rows that tie on all others over several tasks of the range
    shuffle, so one frequent key does not land in one task.
    """
    keys = [key if isinstance(key, Column) else F.col(key) for key in order]
    names = {key.lower() for key in order if isinstance(key, str)}
    if offset.lower() not in names:
        keys.append(F.col(offset))
    return df.orderBy(*keys, spread_key(df))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows of the whole table; each task keeps only ``k`` rows."""
    return df.orderBy(*order).limit(k)
