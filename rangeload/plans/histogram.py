"""Distributed histograms of the offset column, and what is cut from them.

A histogram counts rows per bucket with map-side aggregation: about
``MAX_BUCKETS`` small groups are shuffled and collected at most, however large the
table or however skewed its offsets. Buckets that are too full are looked at again, on
their own, so cuts are exact and one frequent value costs nothing extra.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeload.plans.bounds import MOST_CONDITIONS, OffsetRange, Place, hull, predicate_over, with_index
from rangeload.plans.offsets import OffsetType

# Gives the rows inside some spans, with the offset as the column ``offset``.
Offsets = Callable[[list[OffsetRange]], DataFrame]

# Groups of one histogram in all, and the number that fills chunks
# well even where rows crowd.
MAX_BUCKETS = 1 << 16
ENOUGH_BUCKETS = 256


def share(spans: int) -> int:
    """Buckets of each of so many spans; two at least, else nothing is told apart."""
    return max(2, MAX_BUCKETS // spans)


@dataclass
class Bucket:
    """Rows whose offsets lie from ``first`` to ``last``, both present."""

    first: object
    last: object
    rows: int


def offsets_of(df: DataFrame, offset: str) -> Offsets:
    """The offsets of a DataFrame."""
    kind = OffsetType.of(df, offset)

    def inside(spans: list[OffsetRange]) -> DataFrame:
        return df.where(predicate_over(offset, spans, kind)).select(F.col(offset).alias("offset"))

    return inside


def histogram(offsets: Offsets, kind: OffsetType, spans: list[OffsetRange], buckets: int) -> list[list[Bucket]]:
    """Buckets of each of the ``spans``, in offset order.

    The spans ascend, and none holds the lower bound of a later one.
    """
    many = len(spans) > MOST_CONDITIONS and all((s.lo_op, s.hi_op) == (">=", "<=") for s in spans)
    rows = offsets([hull(spans)] if many else spans)
    rows = with_index(rows, "span", "offset", [s.lower for s in spans], kind)
    if many:
        uppers = ", ".join(kind.sql(s.upper) for s in spans)
        rows = rows.where(f"offset <= get(array({uppers}), span)")
    wide = [s for s in spans if s.lower < s.upper]
    place = "0"
    if wide:
        # A span of one value has a single bucket; any width will do for it.
        pairs = [(s.lower, s.upper) if s.lower < s.upper else (wide[0].lower, wide[0].upper) for s in spans]
        position = kind.within("offset", pairs, "span")
        place = f"greatest(least(CAST(floor({position} * {buckets}) AS INT), {buckets - 1}), 0)"
    counted = (
        rows.groupBy("span", F.expr(place).alias("place"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first"), F.max("offset").alias("last"))
        .select(
            "span",
            "place",
            "rows",
            kind.collectable("first").alias("first"),
            kind.collectable("last").alias("last"),
        )
    )
    result: list[list[Bucket]] = [[] for _ in spans]
    for row in sorted(counted.collect(), key=lambda r: (r.span, r.place)):
        result[row.span].append(Bucket(kind.collected(row["first"]), kind.collected(row["last"]), row.rows))
    return result


@dataclass
class Chunk:
    """Rows from ``first`` up to ``cut``, of those at ``cut`` only up to ``place`` if it is given;
    ``full`` if it should be cut further, ``finer`` if it came from cutting another."""

    first: object
    cut: object
    rows: int
    full: bool = False
    finer: bool = False
    place: Place | None = None

    @property
    def end(self) -> tuple:
        """Where it ends, in the order of chunks."""
        return (self.cut, (1,) if self.place is None else (0, *self.place))


# Gives the chunks of the rows in a range of one offset, or None if their places are not known.
Ties = Callable[[OffsetRange, int], list[Chunk] | None]


def chunks_of(buckets: list[Bucket], cap: int) -> list[Chunk]:
    """Neighbouring buckets joined while they hold no more than ``cap`` rows."""
    chunks: list[Chunk] = []
    for bucket in buckets:
        if chunks and chunks[-1].rows + bucket.rows <= cap:
            chunks[-1].cut = bucket.last
            chunks[-1].rows += bucket.rows
        else:
            chunks.append(Chunk(bucket.first, bucket.last, bucket.rows, bucket.rows > cap))
    return chunks


def tied_chunks(rows: DataFrame, value, cap: int) -> list[Chunk] | None:
    """Chunks of at most ``cap`` of the ``rows``, which all have the offset ``value``, by their places.

    Rows are counted in windows of a sixteenth of the cap, so none has more, and of
    the windows in order only the first are fetched; what lies behind them is one chunk,
    to be cut in its turn. None if ``rows`` is no scan of Parquet files.
    """
    width = max(1, cap // 16)
    try:
        placed = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return None
    windows = placed.groupBy("file", F.floor(F.col("row") / width).alias("window")).agg(F.count(F.lit(1)).alias("rows"), F.max("row").alias("last"))
    found = windows.orderBy("file", "window").limit(MAX_BUCKETS).collect()
    chunks: list[Chunk] = []
    for window in found:
        if chunks and chunks[-1].rows + window.rows <= cap:
            chunks[-1].rows += window.rows
            chunks[-1].place = (window.file, window.last)
        else:
            chunks.append(Chunk(value, value, window.rows, finer=True, place=(window.file, window.last)))
    if len(found) < MAX_BUCKETS:
        chunks[-1].place = None
    else:
        chunks.append(Chunk(value, value, cap + 1, full=True, finer=True))
    return chunks


def plan_chunks(offsets: Offsets, kind: OffsetType, ranges: list[OffsetRange], cap: int, total: int) -> list[Chunk]:
    """Chunks of all rows in ``ranges``, found with one pass over the offsets."""
    wanted = max(ENOUGH_BUCKETS, 16 * -(-total // cap))
    buckets = min(wanted, share(len(ranges)))
    return [c for found in histogram(offsets, kind, ranges, buckets) for c in chunks_of(found, cap)]


def _start(span: OffsetRange) -> tuple:
    """Where the rows of ``span`` start, in the order of chunks' ends."""
    if span.after is not None:
        return (span.lower, (0, *span.after))
    return (span.lower, (-1,) if span.lo_op == ">=" else (1,))


def _due(chunks: list[Chunk], span: OffsetRange) -> Chunk | None:
    """The chunk that holds the first rows left in ``span``."""
    at = bisect.bisect_right(chunks, _start(span), key=lambda c: c.end)
    if at == len(chunks) or chunks[at].first > span.upper:
        return None
    return None if chunks[at].first == span.upper and span.hi_op == "<" else chunks[at]


def next_cut(chunks: list[Chunk], span: OffsetRange) -> tuple[object, Place | None] | None:
    """The offset, and the place among its rows, where to stop when loading from the start of ``span``.

    None is the end of the span: no planned row of it lies behind the chunk.
    """
    chunk = _due(chunks, span)
    if chunk is None or chunk.cut > span.upper or (chunk.cut == span.upper and chunk.place is None):
        return None
    following = _due(chunks, span.moved_to(chunk.cut, after=chunk.place))
    return None if following is None else (chunk.cut, chunk.place)


def refine_chunks(
    offsets: Offsets, kind: OffsetType, chunks: list[Chunk], ranges: list[OffsetRange], cap: int, ties: Ties | None = None
) -> tuple[list[Chunk], bool]:
    """Cut the chunks that ``ranges`` are about to load down to ``cap`` rows.

    Only chunks that are next in line are looked at, so a step costs at most a
    few passes over a narrow part of the offset column. A chunk of a single offset is cut by ``ties``.
    Returns the chunks and whether they changed.
    """
    changed = False
    while True:
        due: dict[tuple, Chunk] = {}
        cut: list[Chunk] = []
        for span in ranges:
            chunk = _due(chunks, span)
            if not chunk or not chunk.full or chunk.end in due:
                continue
            due[chunk.end] = chunk
            if chunk.first == chunk.cut:
                after = span.after if span.lower == chunk.cut else None
                found = ties(OffsetRange(0, chunk.cut, chunk.cut, after=after), cap) if ties else None
                cut.extend(found or [replace(chunk, full=False, finer=True)])
        if not due:
            return chunks, changed
        parts = [due[end] for end in sorted(due) if due[end].first < due[end].cut]
        spans = [OffsetRange(i, c.first, c.cut) for i, c in enumerate(parts)]
        found = histogram(offsets, kind, spans, share(len(spans))) if spans else []
        for part, buckets in zip(parts, found, strict=True):
            pieces = chunks_of(buckets, cap)
            if len(pieces) == 1 and (pieces[0].first, pieces[0].cut) == (part.first, part.cut):
                # The values are closer than a bucket can tell apart.
                pieces[0].full = False
            cut.extend(replace(piece, finer=True) for piece in pieces)
        kept = [c for c in chunks if c.end not in due]
        chunks = sorted(kept + cut, key=lambda c: c.end)
        changed = True


def still_open(chunks: list[Chunk], ranges: list[OffsetRange]) -> list[Chunk]:
    """Chunks of which some range has anything left."""
    return [c for c in chunks if any(c.end > _start(r) and c.first <= r.upper for r in ranges)]


def with_finer(chunks: list[Chunk], finer: list[Chunk]) -> list[Chunk]:
    """``chunks`` with what is left of those that were cut finer in their place."""
    cuts = sorted(c.cut for c in finer)
    first = {c.cut: c.first for c in finer}

    def replaced(chunk: Chunk) -> bool:
        at = bisect.bisect_left(cuts, chunk.first)
        return at < len(cuts) and first[cuts[at]] <= chunk.cut

    return sorted([c for c in chunks if not replaced(c)] + finer, key=lambda c: c.end)


#: Of the error of a KLL sketch, ``factor / k ** power`` of the rows for 99 in 100 sketches; the largest k.
KLL_FACTOR, KLL_POWER, KLL_MOST = 2.296, 0.9021, 65_535
#: A sketch of this size keeps so many rows exactly, and costs a task some hundred kilobytes.
KLL_LEAST = 8_192


def sketched_cuts(df: DataFrame, offset: str, parts: int, tolerance: float) -> tuple[object, object, list] | None:
    """First and last offset, and the offsets of the rows ranked about ``ceil(i * rows / parts)``, from one pass.

    Tasks make KLL sketches, which are merged; ranks are off by ``tolerance`` of all rows at most, as 99 sketches in
    100 are. None if the type has no sketch, or one so close would be too large; a table without offsets has none.
    """
    kind = OffsetType.of(df, offset)
    number, needed = kind.number(offset), math.ceil((KLL_FACTOR / tolerance) ** (1 / KLL_POWER)) if tolerance > 0 else KLL_MOST + 1
    if number is None or needed > KLL_MOST:
        return None
    of = "double" if kind.kind == "double" else "bigint"
    values = df.select(kind.usable(F.col(offset)).alias(offset)).select(F.expr(number).alias("unit"))
    sketch = getattr(F, f"kll_sketch_agg_{of}")("unit", F.lit(max(KLL_LEAST, needed)))
    made = values.agg(sketch.alias("sketch"), F.min("unit").alias("first"), F.max("unit").alias("last"))
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else None
    cuts = getattr(F, f"kll_sketch_get_quantile_{of}")("sketch", ranks) if parts > 1 else F.array()
    row = made.select("first", "last", F.when(F.col("first").isNotNull(), cuts).alias("cuts")).first()
    return (row["first"], row["last"], list(row["cuts"] or []))


def quantile_cuts(df: DataFrame, offset: str, whole: OffsetRange, parts: int, tolerance: float = 0.0) -> list:
    """Offsets of the rows ranked ``ceil(i * rows / parts)`` for i = 1 .. parts - 1.

    Each pass narrows every wanted rank to one bucket of the one before. With a
    ``tolerance`` a bucket of up to that share of the rows is close enough, and
    its largest offset is taken.
    """
    kind, offsets = OffsetType.of(df, offset), offsets_of(df, offset)
    first = histogram(offsets, kind, [whole], MAX_BUCKETS)
    total = sum(bucket.rows for bucket in first[0])
    wanted = {i: -(-i * total // parts) for i in range(1, parts)} if total else {}
    answers: dict[int, object] = {}
    # (span, rows below it, parts whose end lies in it) with the buckets of each
    active, found = [(whole, 0, list(wanted))], first
    while active:
        narrowed = []
        for (span, below, ends), counted in zip(active, found, strict=True):
            for bucket in counted:
                inside = [i for i in ends if below < wanted[i] <= below + bucket.rows]
                same = len(counted) == 1 and (bucket.first, bucket.last) == (span.lower, span.upper)
                settled = bucket.first == bucket.last or same or bucket.rows <= tolerance * total
                if inside and settled:
                    answers.update(dict.fromkeys(inside, bucket.last))
                elif inside:
                    narrowed.append((OffsetRange(0, bucket.first, bucket.last), below, inside))
                below += bucket.rows
        active = narrowed
        if active:
            found = histogram(offsets, kind, [span for span, _, _ in active], share(len(active)))
    return [answers[i] for i in sorted(answers)]
