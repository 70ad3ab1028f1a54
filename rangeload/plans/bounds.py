"""Half-open offset ranges: splitting, re-splitting and predicates.

Everything here works on a handful of ranges, never on rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeload.plans.offsets import OffsetType, finite, quoted

# Fixed value: above this many edges a search replaces the decision tree, whose
# generated code would grow past what the JVM compiles.
MOST_CONDITIONS = 32


# A row's place among rows that share an offset: its file and its number there.
Place = tuple[str, int]


@dataclass(frozen=True)
class OffsetRange:
    """Offsets from ``lower`` to ``upper`` (units of :class:`OffsetType`).

    Of the rows at ``lower`` only those behind the place ``after`` belong to it, of those at
    ``upper`` only those up to ``until``; None is no such limit. Places order rows by
    file and row number, which scans of Parquet files have.
    """

    id: int
    lower: object
    upper: object
    lo_op: str = ">="
    hi_op: str = "<="
    loaded: int = 0
    done: bool = False
    after: Place | None = None
    until: Place | None = None

    def predicate(self, name: str, kind: OffsetType) -> str:
        """SQL condition on the offset column, and on files and rows if places limit the range."""
        column, lower, upper = quoted(name), kind.sql(self.lower), kind.sql(self.upper)
        parts = [f"{column} {self.lo_op} {lower}", f"{column} {self.hi_op} {upper}"]
        for place, end, behind in ((self.after, lower, ""), (self.until, upper, "NOT ")):
            if place is None:
                continue
            file, row = f"CAST(X'{place[0].encode().hex()}' AS STRING)", place[1]
            path = "_metadata.file_path"
            parts.append(f"({column} <> {end} OR {behind}({path} > {file} OR ({path} = {file} AND _metadata.row_index > {row})))")
            if self.lower == self.upper:  # other files need not be opened
                parts.append(f"{path} {'<=' if behind else '>='} {file}")
        return f"({' AND '.join(parts)})"

    def moved_to(self, cursor, lo_op: str = ">", after: Place | None = None) -> OffsetRange:
        """What is left of the range once everything up to ``cursor`` is loaded, or of the
        rows at it those up to the place ``after``."""
        return replace(self, lower=cursor, lo_op=">=" if after else lo_op, after=after)

    def holds_nothing(self) -> bool:
        if self.lower == self.upper:
            return (self.lo_op, self.hi_op) != (">=", "<=")
        return self.lower > self.upper


def renumber(ranges: Iterable[OffsetRange]) -> list[OffsetRange]:
    return [replace(r, id=i) for i, r in enumerate(ranges)]


def edges_between(lower, upper, n: int, kind: OffsetType) -> list:
    """The n + 1 equal-width edges; the last is exactly ``upper``."""
    if kind.kind == "double":
        # infinities fall into the outer ranges; the finite part is divided
        low, high = finite(lower), finite(upper)
        if not math.isinf(high - low):
            step = (high - low) / n
            inner = [low + step * i for i in range(1, n)]
        else:
            inner = [low * ((n - i) / n) + high * (i / n) for i in range(1, n)]
        return [lower, *inner, upper]
    step = (upper - lower) // n
    return [lower + step * i for i in range(n)] + [upper]


def split_range(lower, upper, n: int, kind: OffsetType, lo_op: str = ">=", hi_op: str = "<=") -> list[OffsetRange]:
    """``n`` equal-width ranges that together cover ``lower`` to ``upper``.

    The outer operators are the given ones, the inner ones ``<`` and ``>=``.
    Ranges that could hold no value are left out, so fewer than ``n`` come back
    when the interval is too narrow. Equal bounds give one range.
    """
    if n < 1:
        raise ValueError("The number of ranges should be at least 1")
    if lower > upper:
        raise ValueError(
            f"upper bound '{kind.to_text(upper)}' should not be below lower bound '{kind.to_text(lower)}'"
        )
    if not kind.splittable or n == 1 or lower == upper:
        whole = OffsetRange(0, lower, upper, lo_op, hi_op)
        return [] if whole.holds_nothing() else [whole]
    edges = sorted(set(edges_between(lower, upper, n, kind)))
    last = len(edges) - 2
    pieces = [
        OffsetRange(
            i,
            edges[i],
            edges[i + 1],
            lo_op if i == 0 else ">=",
            hi_op if i == last else "<",
        )
        for i in range(last + 1)
    ]
    return renumber(p for p in pieces if not p.holds_nothing())


def ranges_from_edges(edges: Sequence, lo_op: str = ">=", hi_op: str = "<=") -> list[OffsetRange]:
    """Adjoining ranges with the given, possibly repeated, edges."""
    distinct = sorted(set(edges))
    if len(distinct) == 1:
        return [OffsetRange(0, distinct[0], distinct[0], lo_op, hi_op)]
    last = len(distinct) - 2
    return [
        OffsetRange(i, distinct[i], distinct[i + 1], lo_op if i == 0 else ">=", hi_op if i == last else "<")
        for i in range(last + 1)
    ]


def rebuild_ranges(ranges: Sequence[OffsetRange], n: int, kind: OffsetType) -> list[OffsetRange]:
    """Split ranges until there are ``n``: halve from the left, and once a
    single range is left, cut that one into all the pieces still missing."""
    result: list[OffsetRange] = []
    missing = n - len(ranges)
    for position, span in enumerate(ranges):
        if missing <= 0:
            result.extend(ranges[position:])
            break
        alone = position == len(ranges) - 1
        pieces = missing + 1 if alone else 2
        first, *rest = split_range(span.lower, span.upper, pieces, kind, span.lo_op, span.hi_op)
        result.extend([replace(first, after=span.after), *rest])
        missing -= pieces - 1
    return renumber(result)


def recreate_ranges(ranges: Sequence[OffsetRange], n: int, kind: OffsetType) -> list[OffsetRange]:
    """Ranges of the next step.

    Finished ranges go. If at least ``n`` are left they stay as they are, if none
    is left there is no next step, otherwise the rest is re-split into ``n``.
    """
    left = sorted(
        (replace(r, loaded=0) for r in ranges if not (r.done or r.holds_nothing())),
        key=lambda r: r.lower,
    )
    if not left or len(left) >= n or not kind.splittable:
        return renumber(left)
    return rebuild_ranges(left, n, kind)


def planned_ranges(new_rows: int, max_records: int, limit: int, kind: OffsetType) -> int:
    """How many ranges rows found by polling are worth."""
    if not kind.splittable:
        return 1
    return max(1, min(limit, -(-new_rows // max_records)))


def hull(spans: Sequence[OffsetRange]) -> OffsetRange:
    """The closed range around all of the spans."""
    return OffsetRange(0, min(s.lower for s in spans), max(s.upper for s in spans))


def joined(spans: Sequence[OffsetRange]) -> list[OffsetRange]:
    """The same offsets in as few ranges as possible."""
    result: list[OffsetRange] = []
    for span in sorted(spans, key=lambda s: s.lower):
        before = result[-1] if result else None
        touching = before and before.upper == span.lower and "=" in before.hi_op + span.lo_op
        if touching and before.until is None and span.after is None:
            result[-1] = replace(before, upper=span.upper, hi_op=span.hi_op, until=span.until)
        else:
            result.append(span)
    return result


def predicate_over(name: str, spans: Sequence[OffsetRange], kind: OffsetType) -> str:
    """SQL condition for rows in any of the spans. The hull of several spans
    comes first, since every source can prune by it."""
    each = [s.predicate(name, kind) for s in joined(spans)]
    if len(each) == 1:
        return each[0]
    return f"{hull(spans).predicate(name, kind)} AND ({' OR '.join(each)})"


def with_index(df: DataFrame, out: str, name: str, lowers: Sequence, kind: OffsetType) -> DataFrame:
    """Adds the position of the last of the ascending ``lowers`` that is <= the
    column ``name``; values below the first one get position 0."""
    return with_count(df, out, name, lowers[1:], kind, inclusive=True)


def with_count(
    df: DataFrame, out: str, name: str, edges: Sequence, kind: OffsetType, inclusive: bool
) -> DataFrame:
    """Adds how many of the ascending ``edges`` lie below the column ``name``, or
    at it if ``inclusive``.

    Few edges are compared in a decision tree. Many are searched by halving, one
    projection per halving, which compiles to a short chain of array lookups.
    """
    column, above = quoted(name), ">=" if inclusive else ">"
    literals = [kind.sql(edge) for edge in edges]
    if len(literals) <= MOST_CONDITIONS:
        return df.withColumn(out, F.expr(_tree(column, above, literals, 0)))
    values, at = f"array({', '.join(literals)})", quoted(out)
    df = df.withColumn(out, F.lit(0))
    for bit in reversed(range(len(literals).bit_length())):
        jump = 1 << bit
        passed = f"{at} + {jump} <= {len(literals)} AND {column} {above} get({values}, {at} + {jump - 1})"
        df = df.withColumn(out, F.expr(f"{at} + CASE WHEN {passed} THEN {jump} ELSE 0 END"))
    return df


def _tree(column: str, above: str, edges: list[str], base: int) -> str:
    if not edges:
        return str(base)
    middle = len(edges) // 2
    left = _tree(column, above, edges[:middle], base)
    right = _tree(column, above, edges[middle + 1 :], base + middle + 1)
    return f"CASE WHEN {column} {above} {edges[middle]} THEN {right} ELSE {left} END"
