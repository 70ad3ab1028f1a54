"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rangeload.llm.common import settle


def _turned(*ends: tuple[str, str]) -> Column:
    """A row for each of ``ends``, from one pass over the links."""
    return F.inline(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ends]))


def _least_neighbour(links: DataFrame, upward: bool) -> DataFrame:
    """Links from neighbours of each node to the least of the node and its neighbours.

    ``upward`` takes the neighbours above a node, else those below it. Upward there are no
    more links than before, so repeated ones can stay until the other step.
    """
    if upward:
        both = links.select(_turned(("a", "b"), ("b", "a")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if upward:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.select(_turned(("b", "m"), ("a", "m"))).where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, of every node in ``links`` (``a``, ``b``).

    Alternates two steps that point every node at smaller nodes until all point at the
    least (large star, small star); each round is checkpointed to the shared folder.
    Nothing but a count and a checksum reaches the driver. Nodes are longs. Links with
    a null end or equal ends are left out; repeated links count once.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    links = settle(links.distinct())
    seen = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        links = settle(_least_neighbour(_least_neighbour(links, upward=True), upward=False))
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
