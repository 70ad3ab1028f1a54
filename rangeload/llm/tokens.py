"""Token counts by a two-tier lookup of pre-token lengths, without shuffling any.

A compact table of the lengths of frequent pre-tokens is broadcast; a pre-token that
it lacks is encoded once by the worker that meets it and kept in the worker's own
bounded cache. Every text is counted whole, and the count is always the library's:
table and caches only save repeated work.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rangeload.llm.words import WordTable

#: A cut before white space that follows other characters never joins or splits a pre-token.
_PIECES = re.compile(r"\s*\S+|\s+")
#: A space between other white space: here a cut at every space would split a run.
_INNER_SPACE = re.compile(r"(?<=\s) (?=\s)")
_CACHES: dict = {}


def pre_tokens(text: str) -> list[str]:
    """``text`` cut where no pre-token of byte-level BPE crosses, by single spaces if that is safe."""
    if "  " in text or "\n " in text or _INNER_SPACE.search(text):
        return _PIECES.findall(text)
    first, *rest = text.split(" ")
    pieces = [" " + word for word in rest]
    return [first, *pieces] if first else pieces


def count_tokens(lengths: WordTable, text: str) -> int:
    if lengths.whole_only(text):
        return len(lengths.ids(text))
    return sum(map(lengths.__getitem__, pre_tokens(text)))


def frequent_lengths(df: DataFrame, text: str, path: str, *, table_size: int, sample_rows: int) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a bounded sample of ``df``.

    The sample is spread over the table by a hash of the text and holds about
    ``sample_rows`` rows. It only decides what the table holds, not any count. At most
    ``table_size`` pre-tokens of 40 characters reach the driver.
    """
    share = min(1.0, sample_rows / max(1, df.count()))
    picked = df.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) <= int(share * (1 << 20)))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update(pre_tokens(value))
            kept = [(word, n) for word, n in seen.items() if n > 1 and len(word) <= 40]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"]
            )

    counts = picked.mapInArrow(tally, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = [row["word"] for row in counts.orderBy(F.desc("n"), "word").limit(table_size).collect()]
    encoder = WordTable(path, len, {}, most=table_size + 1)
    return {word: encoder[word] for word in top if not encoder.whole_only(word)}


def token_counts(
    df: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", table_size: int = 65_536, sample_rows: int = 8_192
) -> DataFrame:
    """``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row, as the tokenizer file at ``path`` gives them.

    For byte-level BPE files. No special tokens are added; special strings inside a
    text count as the library's default has them. One pass over the texts and no
    shuffle of them; a worker holds the table, its cache and one batch.

    A null or empty text has 0 bytes and 0 tokens, a null key stays, repeated rows give
    repeated results, an empty table an empty result; other columns are not read.
    """
    lengths = frequent_lengths(df, text, path, table_size=table_size, sample_rows=sample_rows)
    shared = df.sparkSession.sparkContext.broadcast(lengths)
    name = f"{path} {shared.id if hasattr(shared, 'id') else id(shared)} {len(lengths)}"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _CACHES:
            _CACHES.clear()
            _CACHES[name] = WordTable(path, len, shared.value)
        lookup = _CACHES[name]
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                value = value.as_py() or ""
                n_bytes.append(len(value.encode()))
                n_tokens.append(count_tokens(lookup, value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["key", "n_bytes", "n_tokens"]
            )

    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    counted = narrow.mapInArrow(count, f"key {kind}, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("key", key)
