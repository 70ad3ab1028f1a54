"""Near-duplicate vectors by learned binary codes, multi-index tables and exact reranking.

Iterative quantisation learns rotations under which the signs of a vector's components
are balanced and lie close to it. The bits of several such codes are cut into substrings,
one hash table for each; vectors that share a substring are candidates, and the cosine
of the original vectors decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import settle, unpacked, whole
from rangeload.llm.components import connected_components
from rangeload.llm.vectors import by_length

_BITS = 64


def learn_rotation(sample: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """A rotation (dimensions x bits) that makes the signs of ``sample`` times it a close code."""
    bits = min(_BITS, sample.shape[1])
    _, _, axes = np.linalg.svd(sample.T @ sample)
    axes = axes[:bits].T
    flat = sample @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        code = np.where(flat @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(code.T @ flat)
        turn = (u @ v).T
    return axes @ turn


class MultiIndex:
    """Substrings of several codes: the tables a vector is indexed under.

    ``width`` bits of a substring grow with the logarithm of the number of vectors. As
    many tables are made as it takes for pairs at exactly the threshold, drawn around
    the vectors of the sample, to share one with probability ``recall``; it is an error if that
    takes more than ``most_tables``.
    """

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, recall: float, most_tables: int = 512):
        self.width = min(30, max(6, math.ceil(math.log2(max(2, rows))) + 1))
        bits = min(_BITS, sample.shape[1])
        few = len(sample) < 4 * bits  # these would not balance a code: random rotations around zero
        self.mean = np.zeros(sample.shape[1]) if few else sample.mean(axis=0)
        centred = sample - self.mean
        draw = np.random.default_rng(5)
        noise = draw.normal(size=sample.shape)
        noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
        noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
        partner = threshold * sample + math.sqrt(1 - threshold**2) * noise
        self.rotations: list[np.ndarray] = []
        self.tables = 0
        missed = np.ones(len(sample), bool)
        while missed.mean() > 1 - recall and bits:
            if self.tables >= most_tables:
                raise ValueError(f"{most_tables} tables find {1 - missed.mean():.3f} of pairs at {threshold}, not {recall}; allow more or ask for less")
            if few:
                turn, _ = np.linalg.qr(np.random.default_rng(len(self.rotations)).normal(size=(sample.shape[1], sample.shape[1])))
                self.rotations.append(turn[:, :bits])
            else:
                self.rotations.append(learn_rotation(centred, len(self.rotations)))
            self.tables = len(self.rotations) * bits // self.width
            if self.tables:
                missed = ~(self.keys(sample) == self.keys(partner)).any(axis=1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """The substring of each table (columns) for each row."""
        signs = np.concatenate([(unit - self.mean) @ r >= 0 for r in self.rotations], axis=1)
        signs = signs[:, : self.tables * self.width].reshape(len(unit), self.tables, self.width)
        return signs @ (1 << np.arange(self.width, dtype=np.int64))


def unit_rows(ids: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are not zero, scaled to length one."""
    largest = np.abs(matrix).max(axis=1, initial=0.0)
    ids, matrix, largest = ids[largest > 0], matrix[largest > 0], largest[largest > 0]
    matrix = matrix / largest[:, None]
    return ids, matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def close_pairs(unit: np.ndarray, starts: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one unit whose cosine reaches ``threshold``; units begin at ``starts``, which ends with the last row's end."""
    sizes = np.diff(starts)
    for size in np.unique(sizes).tolist():
        firsts = starts[:-1][sizes == size]
        if size <= 16:  # all small units of one size at once
            a, b = np.triu_indices(size, 1)
            for at in range(0, len(firsts), 1024):
                some = firsts[at : at + 1024, None]
                x, y = (some + a).ravel(), (some + b).ravel()
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
                yield x[near], y[near]
        else:
            for first in firsts.tolist():
                rows = unit[first : first + size]
                a, b = np.nonzero(np.triu(rows @ rows.T >= threshold, 1))
                yield a + first, b + first


def first_meeting(keys: np.ndarray, tab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share no table before the one of their unit, so that each pair counts once."""
    alive = np.arange(len(a))
    for t in range(int(tab[a].max(initial=0))):
        x, y = a[alive], b[alive]
        met = (tab[x] > t) & (keys[t, x] == keys[t, y])
        alive = alive[~met]
    found = np.zeros(len(a), bool)
    found[alive] = True
    return found


def near_duplicates(
    df: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.97,
    sample_rows: int = 4096,
    block_rows: int = 256,
) -> DataFrame:
    """``df`` with ``n_links``, ``component_id`` and ``kept``.

    Vectors whose cosine is ``threshold`` or more link; ``n_links`` counts the other rows
    a row is linked with, ``component_id`` is the least key reachable, and one row of
    each component is ``kept``. No pair below the threshold is ever linked; a pair at it
    is found with probability ``recall``, closer ones more often.

    Equal vectors are one node. Substrings that many vectors share are worked through in
    blocks of ``block_rows`` against each other; pairs stay inside a task, which gives
    back counts and a spanning forest. Only the sample for the rotations, ``sample_rows`` vectors
    of each length at most, and a few numbers reach the driver.

    Null and zero vectors, those with null or non-finite components, and rows with a
    null key link with nothing: 0 links, their own component, kept. Vectors of other
    lengths never link. Repeated rows link with each other; where they repeat a key,
    all that have the least one are kept. Keys are longs. Input columns named like an
    added one are replaced; an empty table gives an empty result.
    """
    spark = df.sparkSession
    columns = df.columns
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    grouped = rows.where(F.col("id").isNotNull() & usable("vector")).groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    # a number for each vector, since an id may be on several
    nodes = settle(grouped.withColumn("id", F.monotonically_increasing_id()))
    sample: dict[int, list] = {}
    by_hash = Window.partitionBy(F.size("vector")).orderBy(F.xxhash64("vector"), "id")
    picked = nodes.select("id", "vector", F.row_number().over(by_hash).alias("nth")).where(F.col("nth") <= sample_rows)
    for batch in picked.select("id", "vector").toArrow().to_batches():
        for n, (ids, matrix) in by_length(batch.column(0), batch.column(1)).items():
            sample.setdefault(n, []).append(unit_rows(ids, matrix)[1])
    many = nodes.count()
    indexes = {}
    for n, parts in sample.items():
        joined = np.concatenate(parts)
        if n and len(joined):
            indexes[n] = MultiIndex(joined, many, threshold, recall)
    shared = spark.sparkContext.broadcast(indexes)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (ids, matrix) in by_length(batch.column(0), batch.column(1)).items():
                ids, unit = unit_rows(ids, matrix)
                tables = shared.value.get(n)
                for at in range(0, len(ids) if tables else 0, 1024):
                    keys = tables.keys(unit[at : at + 1024])
                    wide = keys.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(ids[at : at + 1024], wide)),
                            pa.array(np.full(keys.size, n, np.int32)),
                            pa.array(np.tile(np.arange(wide, dtype=np.int32), len(keys))),
                            pa.array(keys.ravel()),
                        ],
                        ["id", "length", "tab", "sub"],
                    )

    place = ["length", "tab", "sub"]
    entries = nodes.select("id", "vector").mapInArrow(index, "id long, length int, tab int, sub long")
    entries = settle(entries)
    crowds = entries.groupBy(*place).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows)
    own = F.pmod(F.xxhash64("id"), blocks)
    members = entries.join(crowds, place).select("id", *place, blocks.alias("blocks"), own.alias("own"))
    members = members.select("id", *place, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    members = members.select("id", *place, "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    units = [*place, "low", "high"]
    met = members.join(nodes.drop("least"), "id").repartition(*units).sortWithinPartitions(*units).select("id", "weight", "vector", "own", *units)

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            # units are whole in what is worked on: the last unit of a batch waits for the next batch
            changes = np.zeros(len(batch), bool)
            for name in units:
                column = batch.column(name).to_numpy(zero_copy_only=False)
                changes[1:] |= column[1:] != column[:-1]
            last = int(np.nonzero(changes)[0][-1]) if changes.any() else 0
            if last:
                yield from judge([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
            elif held and any(held[-1].column(c)[len(held[-1]) - 1] != batch.column(c)[0] for c in units):
                yield from judge(held)
                held = [batch]
            else:
                held.append(batch)
        if held:
            yield from judge(held)

    def judge(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        length = table["length"].to_numpy()
        for n in np.unique(length).tolist():
            part = table.filter(pa.array(length == n)).combine_chunks()
            ids, unit = unit_rows(*by_length(part["id"].combine_chunks(), part["vector"].combine_chunks())[n])
            weight, tab, sub, low, high, own = (part[c].to_numpy() for c in ("weight", "tab", "sub", "low", "high", "own"))
            first = np.concatenate([[True], (tab[1:] != tab[:-1]) | (sub[1:] != sub[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            starts = np.append(np.nonzero(first)[0], len(ids))
            keys = np.concatenate([shared.value[n].keys(unit[at : at + 4096]) for at in range(0, len(unit), 4096)]).T.copy()
            counts = np.zeros(len(ids), np.int64)
            ends = []
            for a, b in close_pairs(unit, starts, threshold):
                # a block's own pairs are counted in its unit with itself
                mine = ((low[a] == high[a]) | (own[a] != own[b])) & first_meeting(keys, tab, a, b)
                a, b = a[mine], b[mine]
                counts += np.bincount(a, weight[b], len(ids)).astype(np.int64) + np.bincount(b, weight[a], len(ids)).astype(np.int64)
                ends.append(np.array(list(forest(ids, a, b)), np.int64).reshape(-1, 2))
            links = np.concatenate(ends) if ends else np.zeros((0, 2), np.int64)
            some = counts > 0
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(np.concatenate([ids[some], links[:, 0]])),
                    "n": pa.array(np.concatenate([counts[some], np.zeros(len(links), np.int64)])),
                    "b": pa.array(np.concatenate([np.full(some.sum(), -1), links[:, 1]]), mask=np.arange(some.sum() + len(links)) < some.sum()),
                }
            )

    judged = settle(met.mapInArrow(rerank, "a long, n long, b long"))
    linked = judged.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    roots = connected_components(judged.where("b is not null").select("a", "b"))
    nodes = nodes.join(linked, "id", "left").join(roots.select(F.col("node").alias("id"), F.col("component").alias("root")), "id", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "id"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component"))
    nodes = nodes.join(least, "root").select(F.col("vector").alias("same"), F.coalesce("others", F.lit(0)).alias("others"), "component", "weight")
    component = F.col("component")
    alone = F.col("id").isNull() | ~usable("vector")
    packed = df.select(whole(df).alias("row"), F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"))
    result = packed.join(nodes, F.col("vector") == F.col("same"), "left").select(
        "row",
        F.when(alone, 0).otherwise(F.col("others") + F.col("weight") - 1).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(component).alias("component_id"),
        F.when(alone, True).otherwise(F.col("id") == component).alias("kept"),
    )
    return unpacked(result, "row", columns, "n_links", "component_id", "kept")


def usable(vector: str):
    """Whether a vector is there, not zero, and without null or non-finite components."""
    whole_numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & whole_numbers & F.exists(vector, lambda x: x != 0)


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links from every linked row to the least id it reaches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(ids[a].tolist(), ids[b].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return ((x, root(x)) for x in list(parent) if root(x) != x)
