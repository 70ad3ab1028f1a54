"""Uniform random shards by an exact communication matrix.

How many rows go from each input partition to each shard is drawn from
the multivariate hypergeometric law of a uniform shuffle, so shard sizes are exact.
The matrix is never held: a task draws its own row by descending a binary tree over
the partitions, where each node splits its shards' counts between its two halves with a
generator seeded by the node, so all tasks agree on every split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import unpacked, whole, written


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Rows of each shard; they differ by one at most."""
    sizes = np.full(shards, rows // shards, dtype=np.int64)
    sizes[: rows % shards] += 1
    return sizes


def matrix_row(sizes: np.ndarray, counts: np.ndarray, part: int, seed: int) -> np.ndarray:
    """How many rows of partition ``part`` go to each shard."""
    left = sizes
    low, high = 0, len(counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        first = draw.multivariate_hypergeometric(left, before[middle] - before[low], method="marginals")
        left, low, high = (first, low, middle) if part < middle else (left - first, middle, high)
    return left


def shuffle_into_shards(
    df: DataFrame, shards: int = 24, *, seed: int = 1, cell_rows: int = 4096, settled: bool = False
) -> DataFrame:
    """Every row of ``df`` with ``shard`` and ``slot``, a uniformly random order.

    Shards hold as many rows as each other or one more; slots of a shard run from 0
    without a gap. Rows are first permuted within their input partition by the drawn
    counts, then exchanged, then permuted within their shard: by random numbers, which cut it into cells of about
    ``cell_rows`` rows, so that no task orders a whole shard. What a task draws
    grows with the shards and the logarithm of the partitions.

    Rows are written to the shared folder first, each with its partition and place, so
    that neither a repeated task nor another cut of the scan, which follows the cores
    registered when it is planned, draws otherwise. ``settled`` says that ``df`` has the
    same rows in the same partitions and order whenever it is planned, as a checkpoint
    does and a scan of files need not, and saves the write. The driver gets one count per
    input partition.

    Nulls and texts of any length move like other values, repeated rows are rows of
    their own, an empty table gives an empty result, and input columns named ``shard``
    or ``slot`` are replaced.
    """
    if shards < 1 or cell_rows < 1:
        raise ValueError("shards and cell_rows must be positive")
    columns = df.columns
    # monotonically_increasing_id is the partition in the upper and the row's place in the lower 33 bits
    placed = df.select(whole(df).alias("row"), F.monotonically_increasing_id().alias("place"))
    if not settled:
        placed = written(placed, "shards")
    counted = placed.groupBy(F.shiftright("place", 33).alias("part")).count().collect()
    counts = np.zeros(1 + max((row["part"] for row in counted), default=0), dtype=np.int64)
    for row in counted:
        counts[row["part"]] = row["count"]
    rows = int(counts.sum())
    cells = max(1, -(-(-(-rows // shards)) // cell_rows))
    known = df.sparkSession.sparkContext.broadcast(counts)

    @F.pandas_udf("int")
    def shard_of(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        part, shard = None, None
        for place in places:
            place = place.to_numpy()
            found = np.zeros(len(place), np.int32)
            # a task may read several written partitions, one after another
            cuts = np.flatnonzero(np.diff(place >> 33)) + 1
            for some in np.split(np.arange(len(place)), cuts) if len(place) else ():
                if part != int(place[some[0]] >> 33):
                    part = int(place[some[0]] >> 33)
                    row = matrix_row(shard_sizes(rows, shards), known.value, part, seed)
                    shard = np.repeat(np.arange(len(row), dtype=np.int32), row)
                    np.random.default_rng([seed, part]).shuffle(shard)
                found[some] = shard[place[some] & ((1 << 33) - 1)]
            yield pd.Series(found)

    # the second permutation: rows of a shard in the order of random numbers, cell by cell
    number = F.xxhash64("place", F.lit(seed))
    placed = placed.withColumn("shard", shard_of("place")).withColumn("cell", F.pmod(number, F.lit(cells)).cast("int"))
    sizes = placed.groupBy("shard", "cell").count()
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    local = Window.partitionBy("shard", "cell").orderBy(number, "place")
    ranked = placed.withColumn("n", F.row_number().over(local) - 1).join(starts, ["shard", "cell"])
    return unpacked(ranked.withColumn("slot", (F.col("start") + F.col("n")).cast("long")), "row", columns, "shard", "slot")
