"""Select-project-filter scan of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from rangeload.operators.filters import apply_filters, as_column


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Every name must be a plain column of the table."""
    known = {name.lower() for name in df.columns}
    for name in columns:
        if not isinstance(name, str):
            raise ValueError(f"Only column names are allowed in a scan: {name}")
        if name.lower() not in known:
            raise ValueError(f"No column '{name}'. Available columns: {', '.join(df.columns)}")


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | str | Sequence[Column | str] = (),
    include_deleted: bool = True,
    deleted: Column | str | None = None,
) -> DataFrame:
    """Chosen columns, in the given order and spelling, of the rows that match.

    ``where`` may use columns that are not selected. ``deleted`` is the condition
    that marks a deleted row; ``include_deleted=False`` drops those rows.
    """
    filters = [where] if isinstance(where, (Column, str)) else list(where)
    if not include_deleted:
        if deleted is None:
            raise ValueError("include_deleted=False needs the condition that marks deleted rows")
        filters.append(~as_column(deleted))
    rows = apply_filters(df, *filters)
    if columns is None or (len(columns) == 1 and isinstance(columns[0], str) and columns[0] == "*"):
        return rows
    check_columns(df, columns)
    return rows.select(*columns)
