"""Document quality by a small convolutional network over bytes, in numpy.

Filters of ``WIDTH`` bytes are laid over the whole text every ``STRIDE`` bytes. Chunks of
``CHUNK`` filter positions, each overlapping the next, are max-pooled into one feature
per filter and scored by a linear layer; the mean of the chunks' scores gives the
document's probability. Embedding and filter are one: a filter is a table of weights by
place and byte, so applying it is adding table entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeload.llm.common import settle

WIDTH, STRIDE = 8, 4
#: Filter positions of a block, of a chunk, and between the starts of chunks.
BLOCK, CHUNK, HOP = 16, 64, 48
_PIECE = (CHUNK - 1) * STRIDE + WIDTH


def padded(data: bytes) -> np.ndarray:
    """Bytes with zeros behind, so that the last filter position ends with the text or after it."""
    positions = max(1, -(-(len(data) - WIDTH) // STRIDE) + 1)
    found = np.zeros((positions - 1) * STRIDE + WIDTH, np.uint8)
    found[: len(data)] = np.frombuffer(data, np.uint8)
    return found


class ByteNetwork:
    """Weights of the filters (place, byte, filter), their offsets, and of the linear layer."""

    def __init__(self, filters: int = 32, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.tables = draw.normal(0, 0.3, (WIDTH, 256, filters)).astype(np.float32)
        self.tables[:, 0] = 0
        self.offset = np.zeros(filters, np.float32)
        self.weight = np.zeros(filters + 1, np.float32)
        self.bias = np.zeros(1, np.float32)
        self.combination = np.array([1.0, 0.0, 0.0, 0.0, 0.0])

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01) -> None:
        """Adam on the cross-entropy of chunks, each labelled as its document."""
        if not len(texts):
            return
        draw = np.random.default_rng(11)
        pieces = [padded(t[:_PIECE]) for t in texts]
        data = np.zeros((len(texts), _PIECE), np.uint8)
        last = np.zeros(len(texts), np.int64)
        for i, piece in enumerate(pieces):
            data[i, : len(piece)] = piece
            last[i] = (len(piece) - WIDTH) // STRIDE
        known = [self.tables, self.offset, self.weight, self.bias]
        moments = [(np.zeros_like(x), np.zeros_like(x)) for x in known]
        self.bias[:] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
        places = np.arange(CHUNK) * STRIDE
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(texts))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                some = data[rows]
                acts = sum(self.tables[j][some[:, places + j]] for j in range(WIDTH))
                acts[np.arange(CHUNK)[None, :] > last[rows, None]] = -np.inf
                best = acts.argmax(axis=1)
                top = np.take_along_axis(acts, best[:, None, :], axis=1)[:, 0] + self.offset
                features = np.column_stack([np.maximum(top, 0), filled(last[rows] + 1)])
                wrong = (1 / (1 + np.exp(-(features @ self.weight + self.bias))) - labels[rows]) / len(rows)
                if step == 0:
                    self.weight[:] = draw.normal(0, 0.1, len(self.weight))
                back = (wrong[:, None] * self.weight[:-1] * (top > 0)).astype(np.float32)
                slopes = [np.zeros_like(self.tables), back.sum(axis=0), features.T @ wrong, np.array([wrong.sum()])]
                filters = np.broadcast_to(np.arange(best.shape[1]), best.shape)
                for j in range(WIDTH):
                    np.add.at(slopes[0][j], (np.take_along_axis(some, best * STRIDE + j, axis=1), filters), back)
                slopes[0][:, 0] = 0
                step += 1
                for value, slope, (first, second) in zip(known, slopes, moments, strict=True):
                    first += 0.1 * (slope - first)
                    second += 0.001 * (slope * slope - second)
                    value -= (rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def paired(self) -> np.ndarray:
        """Tables for two bytes at a time, half as many to look up."""
        even, odd = self.tables[0::2], self.tables[1::2]
        return (even[:, :, None, :] + odd[:, None, :, :]).reshape(WIDTH // 2, 65_536, -1)

    def fit_combination(self, summaries: np.ndarray, labels: np.ndarray, rounds: int = 50) -> None:
        """How the summary of a text makes its probability: logistic regression by Newton's method."""
        if not len(labels):
            return
        inputs = np.column_stack([summaries, np.ones(len(labels))])
        weights = np.zeros(inputs.shape[1])
        for _ in range(rounds):
            chance = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
            slope = inputs.T @ (chance - labels) + 0.1 * weights
            curve = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + 0.1 * np.eye(len(weights))
            weights -= np.linalg.solve(curve, slope)
        self.combination = weights

    def score(self, text: bytes, pairs: np.ndarray) -> float:
        """The probability of label 1."""
        logit = self.summary(text, pairs) @ self.combination[:-1] + self.combination[-1]
        return float(1 / (1 + np.exp(-np.clip(logit, -60, 60))))

    def summary(self, text: bytes, pairs: np.ndarray) -> tuple[float, ...]:
        """Of the scores of a text's chunks: mean, least, lowest fifth, and the logarithm of their number."""
        data = padded(text)
        words = data.view(">u2") if len(data) % 2 == 0 else data[: len(data) // 2 * 2].view(">u2")
        positions = (len(data) - WIDTH) // STRIDE + 1
        blocks = np.empty((-(-positions // BLOCK), pairs.shape[2]), np.float32)
        step = BLOCK * 32
        for at in range(0, positions, step):
            end = min(positions, at + step)
            start = at * STRIDE // 2
            width = (end - at - 1) * STRIDE // 2 + 1
            acts = pairs[0].take(words[start : start + width : STRIDE // 2], axis=0)
            for j in range(1, WIDTH // 2):
                acts += pairs[j].take(words[start + j : start + j + width : STRIDE // 2], axis=0)
            blocks[at // BLOCK : -(-end // BLOCK)] = np.maximum.reduceat(acts, np.arange(0, end - at, BLOCK), axis=0)
        per, hop = CHUNK // BLOCK, HOP // BLOCK
        chunks = np.maximum.reduceat(blocks, bounds(len(blocks), per, hop), axis=0)[::2] if len(blocks) > per else blocks.max(axis=0, keepdims=True)
        features = np.column_stack([np.maximum(chunks + self.offset, 0), np.full(len(chunks), filled(min(positions, CHUNK)))])
        logits = np.clip(features.astype(np.float64) @ self.weight.astype(np.float64) + float(self.bias[0]), -30, 30)
        return logits.mean(), logits.min(), np.quantile(logits, 0.2), np.log(len(logits))


def filled(positions):
    """How much of a chunk a text fills, as one more feature."""
    return np.log(positions / CHUNK)


def bounds(blocks: int, per: int, hop: int) -> np.ndarray:
    """Starts and ends of chunks in turn; the last chunk ends with the blocks."""
    starts = np.append(np.arange(0, blocks - per, hop), blocks - per)
    both = np.stack([starts, starts + per], axis=1).ravel()
    return both[:-1] if both[-1] == blocks else both


def learning_rows(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, sample_rows: int) -> DataFrame:
    """``text`` and ``label`` of about ``sample_rows`` labelled rows at most, picked by a hash of their text."""
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    share = int(min(1.0, sample_rows / max(1, marked.count())) * (1 << 30))
    known = docs.select(key, F.col(text).alias("text")).where("text is not null")
    return known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share).join(marked, key).select("text", "label").distinct()


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = 6_000,
    pieces: int = 4,
) -> ByteNetwork:
    """A network fitted to labelled rows of ``docs``, a bounded sample of about ``sample_rows`` of them.

    The filters learn from ``pieces`` chunks from anywhere in each text, which is all
    text that reaches the driver; how a text's chunks make one probability is then
    learned from the whole texts, summarised where they are. Rows without a label of 0
    or 1 and null texts teach nothing. With nothing to learn from, every score is one half.
    """
    rows = settle(learning_rows(docs, labels, key=key, text=text, label=label, sample_rows=sample_rows))
    room = F.greatest(F.lit(1), F.length("text") - _PIECE)
    start = F.pmod(F.xxhash64("nth", "text"), room).cast("int") + 1
    cut = rows.select("label", "text", F.explode(F.sequence(F.lit(1), F.lit(pieces))).alias("nth"))
    chunks = sorted(tuple(row) for row in cut.select(F.substring("text", start, F.lit(_PIECE)).alias("piece"), "label").collect())
    network = ByteNetwork()
    network.fit([piece.encode() for piece, _ in chunks], np.array([y for _, y in chunks], np.float32))
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value.paired()
        for batch in batches:
            found = [list(map(float, shared.value.summary(value.as_py().encode(), pairs))) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], ["summary", "label"])

    known = sorted(tuple(row) for row in rows.mapInArrow(summarise, "summary array<double>, label int").collect())
    network.fit_combination(np.array([s for s, _ in known]), np.array([y for _, y in known], np.float64))
    return network


def score_quality(df: DataFrame, network: ByteNetwork, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` of every row, from its whole text.

    A null text counts as empty; an empty one is scored as padding alone. Null keys and
    repeated rows stay; an empty table gives an empty result; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value.paired()
        for batch in batches:
            found = [shared.value.score((value.as_py() or "").encode(), pairs) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["key", "score"])

    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(judge, f"key {kind}, score double").withColumnRenamed("key", key)


def keep_likely(df: DataFrame, network: ByteNetwork, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose text scores ``least`` or more, as they are."""
    shared = df.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("boolean")
    def likely(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pairs = shared.value.paired()
        for texts in parts:
            yield pd.Series([shared.value.score((value or "").encode(), pairs) >= least for value in texts], dtype=bool)

    return df.where(likely(F.col(text)))
