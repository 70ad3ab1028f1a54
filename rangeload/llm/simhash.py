"""Near-duplicate documents by SimHash fingerprints and one-wildcard segment variants.

Fingerprints that differ in at most two of 64 bits agree, up to one bit, on one of two
32-bit segments. Every fingerprint is indexed by its segments with each bit in turn
left out; fingerprints that share such a variant are candidates and are verified. To count
them, eight rows of a fingerprint are shuffled, its segments less a byte each, and the 64 variants
are made in the tasks that get these; only members of a variant of three or more are shuffled by it. Where
many fingerprints share one variant, as in a large group of near copies, pairs would
grow with the square of the group: there, the members are matched on the whole
fingerprint with one bit left out or none. Two fingerprints differ in at most two bits
exactly if one bit turned in each, or none, makes them equal, so those classes hold all
links of the crowd, at most 65 fingerprints each, and need no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeload.llm.common import settle
from rangeload.llm.components import connected_components


def simhash(text: str | None, width: int = 3, seed: int = 42) -> int:
    """A 64-bit fingerprint: each bit set if it is set in over half the hashes of word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of ``hashes``; memory stays bounded for very long texts."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``key`` and ``fp``, the fingerprint of the whole text as a signed long.

    Words are what ASCII white space separates, with A-Z lowered; shingles have
    ``width`` words, or all words of a shorter text. A null text or one without words
    has fingerprint 0. Other columns are not read.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(value.as_py(), width, seed) for value in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(compute, f"key {kind}, fp long").withColumnRenamed("key", key)


def _places(distinct: DataFrame) -> DataFrame:
    """(``place``, ``fp``): each ``fp`` eight times, by one of its segments without one of its bytes."""
    rest = "fp & ~shiftleft(255L, 8 * byte)"
    place = f"byte * 4294967296L + if(byte < 4, {rest} & 4294967295L, shiftrightunsigned({rest}, 32))"
    return distinct.selectExpr("fp", "explode(sequence(0, 7)) as byte").selectExpr(f"{place} as place", "fp")


def _variants(placed: DataFrame) -> DataFrame:
    """(``place``, ``variant``, ``fp``): the eight variants of a place, its byte with each bit in turn left out."""
    byte = "cast(shiftrightunsigned(fp, 8 * cast(shiftright(place, 32) as int)) & 255 as int)"
    each = placed.selectExpr("*", "explode(sequence(0, 7)) as bit")
    return each.selectExpr("place", f"bit * 256 + ({byte} & ~shiftleft(1, bit)) as variant", "fp")


def fingerprint_links(distinct: DataFrame, crowd: int = 8) -> DataFrame:
    """Links (``a``, ``b``) that join any two of the distinct ``fp`` within two bits, directly or through others.

    Up to ``crowd`` fingerprints of one variant are compared pair by pair.
    """
    key = ["place", "variant"]
    placed = _places(distinct)
    # a variant is in one place, so places are dealt out and each row becomes eight variants where it arrives
    dealt = placed.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "place")
    counted = _variants(dealt).groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    several = settle(counted.where("n > 1"))
    many = several.where("n > 2").select(*key, "n")
    members = _variants(placed.join(many.select("place").distinct(), "place", "left_semi")).join(many, key)
    gathered = members.where(F.col("n") <= crowd).groupBy(*key).agg(F.collect_list("fp").alias("fps"))
    listed = gathered.select(F.explode("fps").alias("a"), "fps").select("a", F.explode("fps").alias("b")).where("a < b")
    candidates = several.where("n = 2").select("a", "b").union(listed)
    near = candidates.where("bit_count(a ^ b) <= 2")
    crowded = members.where(F.col("n") > crowd).select("fp").distinct()
    around = "explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))) as point"
    turned = crowded.selectExpr("fp", around)
    classes = turned.groupBy("point").agg(F.min("fp").alias("a"))
    starred = turned.join(classes, "point").select("a", F.col("fp").alias("b")).where("a <> b")
    return near.union(starred).distinct()


def with_roots(nodes: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """``nodes``, one row for each ``fp``, with ``root``, the least fingerprint reachable by links.

    Links are those of at most two bits, and ``others`` (``a``, ``b``) if given.
    """
    links = fingerprint_links(nodes.select("fp"))
    linked = connected_components(links.union(others.select("a", "b")) if others else links)
    grouped = nodes.join(linked.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left")
    return grouped.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(df: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``key``, ``fp`` and ``component``, the least key reachable by links of at most two bits.

    Equal fingerprints are one node, whatever number of documents has them. Keys are
    longs; a null key takes part in links but is never a component's least key, and a
    component of null keys alone has a null one. Repeated rows give repeated results.
    """
    prints = settle(fingerprints(df, key=key, text=text, width=width, seed=seed))
    nodes = settle(prints.groupBy("fp").agg(F.min(key).alias("least")))
    grouped = with_roots(nodes)
    least = grouped.groupBy("root").agg(F.min("least").alias("component"))
    by_print = grouped.join(least, "root").select("fp", "component")
    return prints.join(by_print, "fp").select(key, "fp", "component")
