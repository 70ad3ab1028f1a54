"""Best-fit-decreasing packing of token sequences into bins of one capacity.

Only lengths decide a packing and there are at most ``capacity`` different ones, so
the packing of the whole corpus follows from its histogram of lengths: the plan is
computed once over lengths with their counts and then applied to the pieces in
parallel. A segment tree over the remaining capacities finds the tightest open bin in
logarithmic time; pieces of one length that best fit treats alike are placed by one step.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import unpacked, whole, written
from rangeload.llm.words import each_text, id_table, packed


class RemainingCapacities:
    """A segment tree that counts the open bins for each remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        node = self.leaves + remaining
        while node:
            self.tree[node] += bins
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of an open bin that takes ``length``."""
        node = self.leaves + length
        if self.tree[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_plan(histogram: Mapping[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, pieces, pieces per bin, first bin, offset) of a packing.

    Pieces of one length are told apart by rank alone. A row places its ranks into
    consecutive bins from ``first bin``, so many in each, from ``offset`` on. The
    number of rows depends on ``capacity``, not on how many pieces there are.
    """
    tree = RemainingCapacities(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    plan = []
    bins = 0

    def put(remaining: int, first: int, many: int) -> None:
        if remaining and many:
            open_bins.setdefault(remaining, []).append((first, many))
            tree.add(remaining, many)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                fresh = -(-left // (capacity // length))
                put(capacity, bins, fresh)
                bins += fresh
                continue
            first, many = open_bins[remaining].pop()
            tree.add(remaining, -many)
            # a bin stays the tightest one while it takes another piece of this length
            each = remaining // length
            filled = min(many, left // each)
            for count, per_bin in ((filled, each), (int(filled < many), min(left - filled * each, each))):
                if count and per_bin and left:
                    plan.append((length, rank, count * per_bin, per_bin, first, capacity - remaining))
                    put(remaining - per_bin * length, first, count)
                    first, many, rank, left = first + count, many - count, rank + count * per_bin, left - count * per_bin
            put(remaining, first, many)
    return np.array(plan, dtype=np.int64).reshape(-1, 6)


def pack(df: DataFrame, capacity: int, *, length: str = "length", block: str = "block") -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``: every row's place in a best-fit-decreasing packing.

    ``df`` is read three times and has to be the same each time, as a written table is.
    ``block`` names an integer column that cuts ``df`` into parts which one task can
    number; ``rank``, from 0 without gaps for each block and length, numbers them. The
    driver gets one count per length. Numbers of sequences are from 0 without gaps.

    Lengths are from 1 to ``capacity``. An empty table gives an empty result, repeated
    rows are pieces of their own, and input columns named ``sequence_id`` or ``offset``
    are replaced.
    """
    spark = df.sparkSession
    columns = df.columns
    kept = df.select(whole(df).alias("row"), F.col(block).alias("b"), F.col(length).cast("long").alias("len"), F.col("rank").alias("r"))
    sizes = kept.groupBy("b", "len").agg(F.count("*").alias("n"))
    histogram = {row["len"]: row["n"] for row in sizes.groupBy("len").agg(F.sum("n").alias("n")).collect()}
    if histogram and not 0 < min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    before = Window.partitionBy("len").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("b", "len", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    plan = spark.sparkContext.broadcast(best_fit_plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        rows = plan.value
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        most = int(rows[:, 1].max() + rows[:, 2].max() + 1) if len(rows) else 1
        keys = rows[:, 0].astype(object) * most + rows[:, 1] if most > (1 << 50) else rows[:, 0] * most + rows[:, 1]
        for lengths, ranks in parts:
            lengths, ranks = lengths.to_numpy(), ranks.to_numpy()
            at = rows[np.searchsorted(keys, lengths * most + ranks, side="right") - 1]
            nth = ranks - at[:, 1]
            yield pd.DataFrame({"sequence_id": at[:, 4] + nth // at[:, 3], "offset": at[:, 5] + nth % at[:, 3] * lengths})

    ranked = kept.join(starts, ["b", "len"])
    placed = ranked.withColumn("p", place("len", F.col("start") + F.col("r"))).select("row", "p.*")
    return unpacked(placed, "row", columns, "sequence_id", "offset")


def token_pieces(
    df: DataFrame, path: str, capacity: int, *, key: str = "doc_id", text: str = "text", end_id: int = 0, keep_ids: bool = False, most_words: int = 250_000
) -> DataFrame:
    """Every text as token ids with ``end_id`` behind, cut into pieces of ``capacity`` ids.

    For word BPE files that drop white space. Columns: ``key``, ``piece`` (from 0),
    ``start``, ``length``, ``ids_crc32`` (of little-endian unsigned 32-bit ids), ``ids``
    if asked for, and what ``pack`` needs: ``block``, the task that made the piece, and
    ``rank``, its number among the task's pieces of that length. A task's words are
    looked up in a cache of twice ``most_words`` at most that its worker keeps; no text is
    shuffled.

    A null text counts as empty and gives one piece of the end id. Repeated rows give
    repeated pieces; an empty table gives none; other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = id_table(path, most_words)
        block = TaskContext.get().partitionId()
        end = packed([end_id])
        step = 4 * capacity
        ranks: dict[int, int] = {}
        for batch in batches:
            keys, pieces, starts, lengths, crcs, ids, rank = [], [], [], [], [], [], []
            for i, data in enumerate(each_text(words, batch.column(1))):
                data += end
                for n, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    length = len(part) // 4
                    keys.append(i)
                    pieces.append(n)
                    starts.append(n * capacity)
                    lengths.append(length)
                    crcs.append(zlib.crc32(part))
                    rank.append(ranks.get(length, 0))
                    ranks[length] = rank[-1] + 1
                    if keep_ids:
                        ids.append(part)
            arrays = [
                batch.column(0).take(pa.array(keys, pa.int64())),
                pa.array(pieces, pa.int32()),
                *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs)],
                pa.array([block] * len(keys), pa.int32()),
                pa.array(rank, pa.int64()),
            ]
            names = ["key", "piece", "start", "length", "ids_crc32", "block", "rank"]
            if keep_ids:
                ends = np.cumsum([0, *lengths]).astype(np.int32)
                flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(ids))])
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, block int, rank long"
    made = narrow.mapInArrow(cut, schema + ", ids array<int>" * keep_ids)
    return made.withColumnRenamed("key", key)


def pack_documents(
    df: DataFrame, path: str, capacity: int = 2048, *, key: str = "doc_id", text: str = "text", keep_ids: bool = False, most_words: int = 250_000
) -> DataFrame:
    """The pieces of every text, each with its ``sequence_id`` and ``offset``.

    The pieces are written once to the shared folder, since their ranks have to stay. ``most_words``
    bounds what a worker keeps and changes no result.
    """
    pieces = written(token_pieces(df, path, capacity, key=key, text=text, keep_ids=keep_ids, most_words=most_words), "pieces")
    return pack(pieces, capacity).drop("block", "rank")
