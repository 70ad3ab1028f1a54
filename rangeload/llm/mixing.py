"""Interleaving sources to target weights by Pfair scheduling of their blocks.

A source's rows, in an order of their own, are cut into blocks of equal size. With weight
w (all weights sum to one), its block k may start at slot floor(k / w) and has to be done
by slot ceil((k + 1) / w); of the blocks that may start, the one with the earliest
deadline takes the next slot. At every slot, each source is then less than one block away
from its weight. Weights are whole parts of a cycle, after which all sources are exactly
on target and the schedule repeats, so that one cycle is a small table to join with.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import unpacked, whole


def cycle_slots(parts: Mapping[str | None, int]) -> list[tuple[str | None, int, int]]:
    """(source, number of its block, slot) for one cycle of ``sum(parts)`` slots."""
    cycle = sum(parts.values())
    order = sorted((s for s in parts if parts[s] > 0), key=lambda s: (s is not None, s))
    waiting = [(0, i, 0) for i in range(len(order))]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    slots = []
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * cycle // parts[order[i]]), i, k))
        _, i, k = heapq.heappop(ready)
        slots.append((order[i], k, slot))
        if k + 1 < parts[order[i]]:
            heapq.heappush(waiting, ((k + 1) * cycle // parts[order[i]], i, k + 1))
    return slots


def tempered_parts(df: DataFrame, source: str, size: Column, total: int, each: int = 50, most: int = 1 << 20) -> dict[str | None, int]:
    """Whole parts for each source that grow with the root of its size.

    There are about ``total`` in all, or ``each`` times the number of sources if that is more, so that an average source's
    weight is rounded by a fiftieth at most; none has less than one part. The driver holds one row for each
    source and a cycle of up to ``most`` slots: a column with more than some ten thousand values, such as web domains, should
    be grouped to fewer sources first.
    """
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("size"))
    roots = {row["source"]: int(row["root"]) for row in sizes.select("source", F.floor(F.sqrt("size")).alias("root")).collect()}
    whole_root = sum(roots.values())
    total = max(total, min(most, each * len(roots)))
    return {name: max(1, root * total // max(1, whole_root)) for name, root in roots.items()}


def mix_sources(
    df: DataFrame,
    parts: Mapping[str | None, int],
    *,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    block_size: int = 65_536,
    piece_rows: int = 16_384,
) -> DataFrame:
    """``df`` with ``block``, ``slot``, ``start`` and ``mix_key``: where each row stands in the mixture.

    ``parts`` gives the weight of every source as whole parts of a cycle. Within a source,
    rows are ordered by the md5 of their key; ``start`` is the summed ``size`` (one each,
    if not given) of the rows before, and a row belongs to the block its start falls in.
    Ordered by ``slot``, ``start`` and ``mix_key`` the rows are the mixture, whose share
    of a source is less than one block, and its last row, away from the weight, for as
    long as every source lasts; a source that has ended leaves its slots empty.

    Running sums are taken in pieces of about ``piece_rows`` rows and then over the
    pieces, so a source that holds most rows is spread over many tasks. All rows are kept,
    also those of a source without parts or weight: they come with a null ``slot``, after the
    rest. A null source is a source of its own; the md5 of a null key is that of a hash of the whole row, so that
    many of them are spread; rows with one key are ordered by their size and then by a hash of the
    row, and rows that are wholly equal have no order; an empty table gives an empty result; input
    columns with the name of an added one are replaced.
    """
    columns = df.columns
    hashable = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    tie = F.xxhash64(*[F.col(f"`{name}`") for name in hashable])
    size = F.lit(1) if size is None else size
    rows = df.select(
        whole(df).alias("row"),
        F.coalesce(F.col(source), F.lit("")).alias("name"),
        F.col(source).isNull().alias("unnamed"),
        size.cast("long").alias("size"),
        F.md5(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null "), tie.cast("string"))).cast("binary")).alias("mix_key"),
        tie.alias("tie"),
    )
    pieces = max(1, df.count() // piece_rows)
    # a piece is an interval of keys, so that pieces in order hold the keys in order
    prefix = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("piece", F.floor(prefix * pieces / (1 << 32)).cast("long"))
    group = ["name", "unnamed", "piece"]
    before = Window.partitionBy("name", "unnamed").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy(*group).agg(F.sum("size").alias("sum")).select(*group, F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy(*group).orderBy("mix_key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(bases, group)
    placed = placed.withColumn("start", F.col("base") + F.col("inner")).withColumn("block", F.floor(F.col("start") / block_size).cast("long"))
    cycle = sum(parts.values())
    slots = df.sparkSession.createDataFrame(
        [(s or "", s is None, parts[s], k, slot) for s, k, slot in cycle_slots(parts)], "name string, unnamed boolean, many long, nth long, first long"
    )
    share = slots.select("name", "unnamed", "many").distinct()
    placed = placed.join(share, ["name", "unnamed"], "left").withColumn("nth", F.col("block") % F.col("many"))
    placed = placed.join(slots.drop("many"), ["name", "unnamed", "nth"], "left")
    slot = F.floor(F.col("block") / F.col("many")).cast("long") * cycle + F.col("first")
    return unpacked(placed.withColumn("slot", slot), "row", columns, "block", "slot", "start", "mix_key")


def in_mixed_order(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix_sources`` sorted into the mixture, without the columns it added."""
    order = [F.col("slot").asc_nulls_last(), "start", "mix_key"]
    return mixed.orderBy(*order).drop("block", "slot", "start", "mix_key")
