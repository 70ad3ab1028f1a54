"""Continuing a range from the last offset that was seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rangeload.plans.bounds import OffsetRange
from rangeload.plans.offsets import OffsetType, quoted

# Delivery guarantee and the comparison it restarts with.
DELIVERY_OPS = {"at_least_once": ">=", "at_most_once": ">"}


def replay_from(df: DataFrame, offset: str, span: OffsetRange, cursor, delivery: str = "at_least_once") -> DataFrame:
    """Rows of ``span`` from ``cursor`` on; the upper bound and its operator stay."""
    kind = OffsetType.of(df, offset)
    moved = span.moved_to(kind.parse(cursor), DELIVERY_OPS[delivery])
    return df.where(moved.predicate(offset, kind))


def drop_replayed(df: DataFrame, *keys: str, offset: str | None = None, cursors: Sequence = ()) -> DataFrame:
    """One row per key; partial aggregation runs before the shuffle.

    A replay repeats only rows that carry the cursor it started at. With
    ``offset`` and the ``cursors`` given, all other rows stay where they are and
    only those few are shuffled.
    """
    if offset is None:
        return df.dropDuplicates(list(keys))
    kind = OffsetType.of(df, offset)
    found = ", ".join(kind.sql(kind.parse(cursor)) for cursor in cursors)
    if not found:
        return df
    repeated = f"coalesce({quoted(offset)} IN ({found}), false)"
    return df.where(f"NOT {repeated}").unionByName(df.where(repeated).dropDuplicates(list(keys)))
