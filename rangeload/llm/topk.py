"""Exact top-k inner products by elimination with pivot tables.

Vectors of integers are lifted to a sphere by one more component, so that a larger inner
product is a smaller distance there. Distances to many pivots are computed once for each
candidate and query; the largest difference of two such distances is a lower bound of
theirs. Candidates of a block are evaluated in the order of their bounds, until the next
bound lies beyond the k-th best distance found, or what is known to be reachable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rangeload.llm.common import written
from rangeload.llm.vectors import by_length

#: Integers up to here are exact in double precision.
_EXACT = 2.0**53


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer-valued rows, cut to the range of a long."""
    if left.size == 0 or right.size == 0:
        return np.zeros((len(left), len(right)))
    if left.shape[1] * np.abs(left).max() * np.abs(right).max() < _EXACT:
        return left @ right.T
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(left) @ whole(right).T, -(2**63), 2**63 - 1)


class PivotSpace:
    """Distances on the sphere around all candidates of one vector length."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest = pivots, largest
        self.lift = np.sqrt(np.maximum(0.0, largest - (pivots * pivots).sum(axis=1)))
        #: More than rounding can take a bound above the true distance.
        self.slack = 1e-6 * np.sqrt(largest) + 1e-9

    def of_candidates(self, vectors: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(0.0, self.largest - (vectors * vectors).sum(axis=1)))
        return np.sqrt(np.maximum(0.0, 2 * self.largest - 2 * (vectors @ self.pivots.T) - 2 * lift[:, None] * self.lift))

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        return self.from_score(vectors, vectors @ self.pivots.T)

    def from_score(self, queries: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, (queries * queries).sum(axis=1)[:, None] + self.largest - 2 * scores))


def choose_pivots(sample: np.ndarray, many: int) -> np.ndarray:
    """Rows of ``sample`` far from each other, greedily."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(many, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def best_of_block(
    space: PivotSpace, queries: np.ndarray, query_ids: np.ndarray, near: np.ndarray, ids: np.ndarray, vectors: np.ndarray, far: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best of a block: (query's place, ids, scores); ``near`` and ``far`` hold distances to the pivots."""
    bounds = np.zeros((len(queries), len(vectors)))
    for p in range(near.shape[1]):
        np.maximum(bounds, np.abs(near[:, p, None] - far[None, :, p]), out=bounds)
    bounds -= space.slack
    for q in range(len(queries)):
        order = np.argsort(bounds[q], kind="stable")
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        at, step, reach = 0, 64, np.inf
        while at < len(order) and bounds[q, order[at]] <= reach:
            some = order[at : at + step]
            some = some[(bounds[q, some] <= reach) & (ids[some] != query_ids[q])]
            scores = products(queries[q : q + 1], vectors[some])[0]
            best_ids, best = np.concatenate([best_ids, ids[some]]), np.concatenate([best, scores])
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
            if len(best) == k:
                reach = space.from_score(queries[q : q + 1], np.array([[float(best[-1])]]))[0, 0] + space.slack
            at, step = at + step, 4 * step
        yield q, best_ids, best


def top_k(
    df: DataFrame,
    is_query,
    k: int = 5,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256.0,
    pivots: int = 32,
    sample_rows: int = 1024,
    query_rows: int = 512,
    block_rows: int = 2048,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best rows.

    Components are ``floor(scale * x)`` and scores exact inner products of them; ties go
    to the smaller id. ``is_query`` is a condition on the rows of ``df``; every row but
    those with the query's own id is its candidate. Candidates and queries are written
    once in blocks with their distances to the pivots, which come from a sample of
    ``sample_rows``; query blocks meet candidate blocks one pair at a time, so a task's
    memory does not depend on how many there are.

    Rows with a null id, a null vector or a null or non-finite component take no part;
    vectors meet those of equal length only. Repeated rows are candidates each, and
    queries each with its own ranks. Too few candidates give fewer ranks; an empty
    table gives none. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))

    def integers(ids: pa.Array, vectors: pa.Array):
        return {n: (found, np.floor(scale * matrix)) for n, (found, matrix) in by_length(ids, vectors).items()}

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {n: float((m * m).sum(axis=1).max()) for n, (_, m) in integers(batch.column(0), batch.column(1)).items()}
            yield pa.RecordBatch.from_pydict({"length": pa.array(list(found), pa.int32()), "most": pa.array(list(found.values()), pa.float64())})

    largest = {
        row["length"]: row["most"]
        for row in rows.select("id", "vector").mapInArrow(norms, "length int, most double").groupBy("length").agg(F.max("most").alias("most")).collect()
    }
    sample = rows.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow().combine_chunks()
    sampled = {}
    for batch in sample.to_batches():
        for n, (_, matrix) in integers(batch.column(0), batch.column(1)).items():
            sampled[n] = np.concatenate([sampled[n], matrix]) if n in sampled else matrix
    spaces = {n: PivotSpace(choose_pivots(sampled.get(n, np.zeros((0, n))), pivots), most) for n, most in largest.items()}
    shared = spark.sparkContext.broadcast(spaces)

    def blocks(size: int, asking: bool):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            waiting: dict[int, list] = {}
            made = TaskContext.get().partitionId() << 32

            def block(n: int, ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
                nonlocal made
                space = shared.value[n]
                far = space.of_queries(matrix) if asking else space.of_candidates(matrix)
                made += 1
                return pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([made - 1], pa.int64()),
                        "length": pa.array([n], pa.int32()),
                        "ids": pa.array([ids.tobytes()], pa.binary()),
                        "data": pa.array([matrix.tobytes()], pa.binary()),
                        "far": pa.array([far.tobytes()], pa.binary()),
                    }
                )

            for batch in batches:
                for n, (ids, matrix) in integers(batch.column(0), batch.column(1)).items():
                    if n in waiting:
                        ids, matrix = np.concatenate([waiting[n][0], ids]), np.concatenate([waiting[n][1], matrix])
                    while len(ids) >= size:
                        yield block(n, ids[:size], matrix[:size])
                        ids, matrix = ids[size:], matrix[size:]
                    waiting[n] = [ids, matrix]
            for n, (ids, matrix) in waiting.items():
                if len(ids):
                    yield block(n, ids, matrix)

        return cut

    layout = "block long, length int, ids binary, data binary, far binary"
    candidates = written(rows.select("id", "vector").mapInArrow(blocks(block_rows, False), layout), "candidates")
    queries = written(rows.where("asks").select("id", "vector").mapInArrow(blocks(query_rows, True), layout), "queries")
    # every query block to every candidate block of its length, in one shuffle of the smaller side
    targets = candidates.select("length", F.col("block").alias("target"))
    sent = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "ids", "data", "far")], "length").join(targets, "length")
    met = sent.join(candidates.withColumnRenamed("block", "target").drop("length"), "target")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                value = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                n = value["length"]
                query_ids, ids = np.frombuffer(value["q_ids"], np.int64), np.frombuffer(value["ids"], np.int64)
                wanted = np.frombuffer(value["q_data"]).reshape(len(query_ids), n)
                vectors = np.frombuffer(value["data"]).reshape(len(ids), n)
                near, far = (np.frombuffer(value[c]).reshape(len(x), -1) for c, x in (("q_far", query_ids), ("far", ids)))
                numbers, asked, found, scores = [], [], [], []
                for q, best_ids, best in best_of_block(shared.value[n], wanted, query_ids, near, ids, vectors, far, k):
                    numbers += [value["q_block"] * query_rows + q] * len(best)
                    asked += [int(query_ids[q])] * len(best)
                    found += best_ids.tolist()
                    scores += [int(s) for s in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (numbers, asked, found, scores)], ["number", "query_id", "vec_id", "score"]
                )

    needed = ["length", "q_block", "q_ids", "q_data", "q_far", "ids", "data", "far"]
    best = met.select(*needed).mapInArrow(search, "number long, query_id long, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
