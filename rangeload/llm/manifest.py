"""Merkle manifest of a dataset, kept as a postorder append log of its digests.

The leaves of a part (here: the documents of a source, in order) are the bottom of a tree in
which every ``FANOUT`` consecutive nodes, or the rest, have a parent. A builder takes an aligned
block of leaves and appends digests as they are completed, so a node stands behind
everything below it. Its place then follows from the number of leaves alone (``position``), and a
sibling is read from the log by computing where it is: nothing but digests is stored.

Builders work side by side. The blocks of one tier end in one node each, and these are the leaves of
the next tier, until a part has a single node left; the ends of the parts make a tree
of their own in the same way. A task holds one block, whatever the size of a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import unpacked, whole, written

FANOUT = 16
LEVELS = 3
#: Leaves of a block: it has ``LEVELS`` levels above them.
BLOCK = FANOUT**LEVELS


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def position(level: int, index: int, leaves: int, fanout: int = FANOUT) -> int:
    """Where node ``index`` of ``level`` (leaves are level 0) stands in the postorder log of a tree.

    Before it stand the nodes under it and under those left of it, the nodes of its level
    left of it, and the parents that these have completed.
    """
    end = min((index + 1) * fanout**level, leaves)
    place, width = index, 1
    for _ in range(level):
        place += -(-end // width)
        width *= fanout
    while index:
        index //= fanout
        place += index
    return place


def height(leaves: int, fanout: int = FANOUT) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // fanout)
        levels += 1
    return levels


def _levels(many: int) -> int:
    """Levels of a block in a part of ``many`` leaves."""
    return height(many) if many <= BLOCK else LEVELS


class Builder:
    """A block under construction: digests in the order in which they were completed."""

    def __init__(self):
        self.nodes: list[str] = []
        self.runs: list[list[str]] = [[]]
        self.leaves = 0

    def _complete(self, level: int, node: str) -> None:
        while True:
            self.nodes.append(node)
            if level == len(self.runs):
                self.runs.append([])
            run = self.runs[level]
            run.append(node)
            if len(run) < FANOUT:
                return
            node, level = digest("".join(run)), level + 1
            run.clear()

    def append(self, leaf: str) -> None:
        self.leaves += 1
        self._complete(0, leaf)

    def close(self, levels: int) -> str:
        """Complete the runs that are open, up to one node at ``levels`` above the leaves; that node."""
        for level in range(levels):
            if self.runs[level]:
                node = digest("".join(self.runs[level]))
                self.runs[level].clear()
                self._complete(level + 1, node)
        return self.nodes[-1]


class Block:
    """A block read from the log."""

    def __init__(self, nodes: bytes, leaves: int, levels: int):
        self.text, self.leaves, self.levels = nodes.hex(), leaves, levels
        self._run: tuple[int, int] | None = None

    def node(self, level: int, index: int) -> str:
        at = 64 * position(level, index, self.leaves)
        return self.text[at : at + 64]

    def run(self, level: int, number: int) -> list[str]:
        last = min((number + 1) * FANOUT, -(-self.leaves // FANOUT**level))
        return [self.node(level, i) for i in range(number * FANOUT, last)]

    def siblings(self, leaf: int) -> list[str]:
        """What stands left and right of each node from the leaf up, two texts a level."""
        if not self.levels:
            return []
        if self._run is None or self._run[0] != leaf // FANOUT:
            above, index = [], leaf // FANOUT
            for level in range(1, self.levels):
                run, at = self.run(level, index // FANOUT), index % FANOUT
                above += ["".join(run[:at]), "".join(run[at + 1 :])]
                index //= FANOUT
            self._run = (leaf // FANOUT, self.run(0, leaf // FANOUT), above)
        _, run, above = self._run
        at = leaf % FANOUT
        return ["".join(run[:at]), "".join(run[at + 1 :]), *above]


def fold(leaf: str, siblings: list[str]) -> str:
    """The root that ``leaf`` and its siblings give."""
    node = leaf
    for left, right in zip(siblings[::2], siblings[1::2], strict=True):
        node = digest(left + node + right)
    return node


def row_digest(columns: list[Column]) -> Column:
    """sha256 of the values one after another, each as its length in bytes, a colon and itself, or ``-`` if null."""
    texts = [column.cast("string") for column in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(df: DataFrame, part: str, order: list[str], rows_each: int = 500_000) -> DataFrame:
    """``df``, written, with ``nth``, the row's number from 0 in its part, and ``many``, the rows of the part.

    Rows are sorted by ranges of part and order together, so a large part, or many rows
    that are equal in both, are spread over tasks; a task numbers its rows, and only one count a task and
    part is summed.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.count() // rows_each)
    by = [part, *order, "tie"]
    placed = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    placed = written(placed.drop("tie").withColumn("place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("task", F.shiftright("place", 33))
    sizes = placed.groupBy(part, "task").agg(F.count("*").alias("rows"), F.min("place").alias("from"))
    whole = Window.partitionBy(part)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        part, "task", "from", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"), F.sum("rows").over(whole).alias("many")
    )
    joined = placed.join(bases, [part, "task"])
    return joined.withColumn("nth", F.col("base") + F.col("place") - F.col("from")).drop("task", "place", "from", "base")


_LOG = "part string, block long, many long, leaves long, digest string, nodes binary"


def _append(items: DataFrame) -> DataFrame:
    """The blocks of one tier from its leaves (``part, nth, many, digest``), written."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, builder = None, None

        def closed() -> pa.RecordBatch:
            part, block, many = current
            end = builder.close(_levels(many))
            values = [part, block, many, builder.leaves, end, bytes.fromhex("".join(builder.nodes))]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["part", "block", "many", "leaves", "digest", "nodes"]
            )

        for batch in batches:
            for part, block, many, leaf in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if current is None or current[:2] != (part, block):
                    if current is not None:
                        yield closed()
                    current, builder = (part, block, many), Builder()
                builder.append(leaf)
        if current is not None:
            yield closed()

    blocks = items.withColumn("block", F.floor(F.col("nth") / BLOCK)).repartition("part", "block").sortWithinPartitions("part", "block", "nth")
    return written(blocks.select("part", "block", "many", "digest").mapInArrow(build, _LOG), "log")


def _tiers(items: DataFrame) -> list[DataFrame]:
    """The log of every part, a written table for each tier of blocks."""
    tiers = [_append(items)]
    while True:
        above = tiers[-1].where(F.col("many") > BLOCK)
        if above.isEmpty():
            return tiers
        parents = above.select("part", F.col("block").alias("nth"), F.ceil(F.col("many") / BLOCK).alias("many"), "digest")
        tiers.append(_append(parents))


def _ends(tiers: list[DataFrame]) -> DataFrame:
    """The last node of each part."""
    found = [tier.where(F.col("many") <= BLOCK).select("part", "digest") for tier in tiers]
    ends = found[0]
    for more in found[1:]:
        ends = ends.union(more)
    return ends


def _with_above(tier: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks with ``above``, the siblings of their end up to the root; ``above`` has (``part, nth, above``)."""
    return tier.join(above.withColumnRenamed("nth", "block"), ["part", "block"])


def _paths(blocks: DataFrame) -> DataFrame:
    """(``part, nth, above``): the siblings up to the root of every leaf of blocks with ``above``."""

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at, many, leaves, nodes, above in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                block = Block(nodes, leaves, _levels(many))
                for start in range(0, leaves, 256):
                    some = range(start, min(start + 256, leaves))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(some), pa.string()),
                            pa.array([at * BLOCK + i for i in some], pa.int64()),
                            pa.array([block.siblings(i) + above for i in some], pa.list_(pa.string())),
                        ],
                        ["part", "nth", "above"],
                    )

    return blocks.select("part", "block", "many", "leaves", "nodes", "above").mapInArrow(climb, "part string, nth long, above array<string>")


@dataclass(frozen=True)
class Manifest:
    """A built manifest: the numbered leaves, the log by tiers of blocks, that of the tree over the parts, and the root.

    ``leaves`` has ``part, nth, many, digest`` and, as ``row``, the given ``columns``.
    """

    columns: list[str]
    leaves: DataFrame
    tiers: list[DataFrame]
    top: list[DataFrame]
    parts: DataFrame
    root: str | None

    def log(self) -> DataFrame:
        """``part``, ``position`` and ``digest`` of all nodes in the blocks of leaves, as the log of each part has them."""
        text = F.lower(F.hex("nodes"))
        places = F.sequence(F.lit(0), (F.length(text) / 64).cast("int") - 1)
        nodes = F.transform(places, lambda at: F.substring(text, at * 64 + 1, F.lit(64)))
        blocks = self.tiers[0].select("part", _block_start(F.col("block")).alias("start"), F.posexplode(nodes).alias("at", "digest"))
        return blocks.select("part", (F.col("start") + F.col("at")).alias("position"), "digest")

    def proofs(self, instead: str | None = None) -> DataFrame:
        """Every row with its leaf's place in the log of its part, its proof, and the root folded from it.

        Added columns, which replace others of their names: ``digest``, ``position``, ``subroot``, ``proof`` (the siblings from the
        bottom up, for each level the digests left and those right of the node, joined) and ``folded``, the root that the
        proof gives for the digest in the column ``instead``, or for the leaf's own where that is null.
        """
        if self.root is None:
            more = ["cast(0 as bigint) position", "digest subroot", "array(digest) proof", "digest folded"]
            return unpacked(self.leaves.selectExpr("*", *more).where("false"), "row", self.columns, *_PROVED)
        ends = self.parts.join(_paths(self._blocks_of_top()).select("nth", "above"), "nth")
        ends = written(ends.select(F.col("name").alias("part"), F.lit(0).cast("long").alias("nth"), "digest", "above"), "ends")
        below = None
        for tier in reversed(self.tiers):
            blocks = _with_above(tier.where(F.col("many") <= BLOCK), ends.select("part", "nth", "above"))
            if below is not None:
                blocks = blocks.unionByName(_with_above(tier.where(F.col("many") > BLOCK), below))
            below = blocks if tier is self.tiers[0] else written(_paths(blocks), "paths")
        heads = blocks.drop("digest").join(ends.select("part", F.col("digest").alias("subroot")), "part")
        given = F.col("digest") if instead is None else F.coalesce(F.col(f"row.`{instead}`"), F.col("digest"))
        rows = self.leaves.withColumn("given", given).withColumn("block", F.floor(F.col("nth") / BLOCK))
        met = rows.unionByName(heads.withColumn("nth", F.lit(-1).cast("long")), allowMissingColumns=True)
        met = met.select("part", "block", "nth", "many", "digest", "row", "given", "leaves", "nodes", "above", "subroot")
        met = met.repartition("part", "block").sortWithinPartitions("part", "block", "nth")
        kind = met.schema["row"].dataType.simpleString()
        schema = f"digest string, row {kind}, position long, subroot string, proof array<string>, folded string"
        return unpacked(met.mapInArrow(_prove, schema), "row", self.columns, *_PROVED)

    def _blocks_of_top(self) -> DataFrame:
        """The blocks over the parts' ends, each with its siblings up to the root."""
        found = self.top[-1].withColumn("above", F.array().cast("array<string>"))
        for tier in reversed(self.top[:-1]):
            found = _with_above(tier, _paths(found))
        return found


_PROVED = ["digest", "position", "subroot", "proof", "folded"]


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Proofs of leaves that follow the block they are in, which comes as a row numbered -1."""
    block, above, subroot, start, first = None, [], None, 0, 0
    for batch in batches:
        numbers = batch.column("nth").to_pylist()
        for low in range(0, len(numbers), 512):
            kept, found = [], []
            for i in range(low, min(low + 512, len(numbers))):
                if numbers[i] < 0:
                    head = {name: batch.column(name)[i].as_py() for name in ("block", "many", "leaves", "nodes", "above", "subroot")}
                    block = Block(head["nodes"], head["leaves"], _levels(head["many"]))
                    above, subroot, first = head["above"], head["subroot"], head["block"] * BLOCK
                    start = position(0, first, head["many"])
                    continue
                at = numbers[i] - first
                siblings = block.siblings(at) + above
                kept.append(i)
                found.append((start + position(0, at, block.leaves), subroot, siblings, fold(batch.column("given")[i].as_py(), siblings)))
            if kept:
                rows = batch.select(["digest", "row"]).take(pa.array(kept, pa.int64()))
                kinds = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.string()]
                more = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *more], ["digest", "row", *_PROVED[1:]])


def _block_start(block: Column) -> Column:
    """Nodes of a part's log before the first leaf of a block: those of the blocks before it, and parents of blocks."""
    start, parents = block * sum(FANOUT**level for level in range(LEVELS + 1)), block
    for _ in range(12):  # 16 ** 12 blocks are more than any table has
        parents = F.shiftright(parents, FANOUT.bit_length() - 1)
        start = start + parents
    return start


def build_manifest(df: DataFrame, *, part: str, order: list[str], leaf: str = "digest") -> Manifest:
    """The manifest of rows that have a digest (lowercase hex sha256) in ``leaf``.

    The leaves of each ``part`` (a text column; null is a part of its own, the first) are in the order of
    the columns ``order``, nulls first, and then of their digests; equal rows are leaves of their own.
    Every 16 consecutive nodes, or the rest, become the sha256 of their digests' hex texts while a part
    has several nodes; the ends of the parts, in bytewise order of their names, are
    joined in the same way to the root. An empty table has no root and no proofs. All columns of ``df`` are
    kept for the proofs, so give those only that are wanted there, and no texts.

    ``df`` is read once and written; its rows are shuffled once to be numbered and once to
    each proof's block. The driver gets the root.
    """
    named = F.when(F.col(part).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(part)))
    keys = [F.col(name).alias(f"key{i}") for i, name in enumerate(order)]
    rows = written(df.select(named.alias("part"), *keys, F.col(leaf).alias("digest"), whole(df).alias("row")), "digests")
    by = [f"key{i}" for i in range(len(order))]
    leaves = numbered(rows, "part", [*by, "digest"]).drop(*by)
    tiers = _tiers(leaves.select("part", "nth", "many", "digest"))
    ends = _ends(tiers).select(F.lit("").alias("part"), F.col("part").alias("name"), "digest")
    parts = numbered(ends, "part", ["name"])
    top = _tiers(parts.select("part", "nth", "many", "digest"))
    root = top[-1].select("digest").first()
    return Manifest(df.columns, leaves, tiers, top, parts.select("name", "nth", "digest"), root["digest"] if root else None)
