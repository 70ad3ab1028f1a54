"""Language of texts by compression with a dictionary per language."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes as the dictionaries and texts are compared: small ASCII letters, other ASCII as space, the rest as it is.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a letter is in ``text``; numerals such as a half or a superscript two are none."""
    return any(found[0].isalpha() for found in _WORDLIKE.finditer(text))


def plain(text: str) -> bytes:
    """Words in small letters with single spaces between."""
    return b" ".join(text.encode().translate(_PLAIN).split())


def learn_dictionaries(
    df: DataFrame, *, text: str = "text", lang: str = "lang", dictionary_bytes: int = 98_304, piece_bytes: int = 1_024
) -> dict[str, bytes]:
    """Raw dictionary content for each language of ``df``, most frequent language first.

    A bounded sample: pieces of at most ``piece_bytes`` from anywhere in texts picked
    by hash, ``dictionary_bytes`` in all for each language. Rows with a null language
    or without a letter teach nothing. The driver gets twice that sample at most, on
    average, and one count per language.
    """
    known = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = {row["lang"]: row["count"] for row in known.groupBy("lang").count().collect()}
    need = 4 * dictionary_bytes // piece_bytes
    wanted = F.lit(False)
    for name, n in counts.items():
        share = int(min(1.0, need / n) * (1 << 30))
        wanted = wanted | ((F.col("lang") == name) & (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share))
    start = F.pmod(F.xxhash64(F.lit(7), "text"), F.greatest(F.lit(1), F.length("text") - piece_bytes)).cast("int") + 1
    pieces = known.where(wanted).select("lang", F.substring("text", start, F.lit(piece_bytes)).alias("piece")).distinct()
    content: dict[str, list[bytes]] = {name: [] for name in counts}
    for row in sorted(pieces.collect()):
        content[row["lang"]].append(plain(row["piece"]))
    found = {}
    for name in sorted(counts, key=lambda name: (-counts[name], name)):
        picked = content[name]
        order = sorted(range(len(picked)), key=lambda i: hash_of(picked[i]))
        joined = b" ".join(picked[i] for i in order)[:dictionary_bytes]
        if joined.strip():
            found[name] = joined
    return found


def hash_of(data: bytes) -> int:
    """A fixed order of pieces that says nothing of their content."""
    return zlib.crc32(data)


class Compressors:
    """A compressor for each language and the sum of a text's compressed pieces."""

    def __init__(self, dictionaries: dict[str, bytes], level: int, piece_bytes: int):
        self.names = list(dictionaries)
        self.piece_bytes = piece_bytes
        self.compressors = []
        for content in dictionaries.values():
            trained = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            trained.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=False, write_content_size=False, write_dict_id=False)
            )

    def sizes(self, data: bytes) -> list[int]:
        pieces = [data[i : i + self.piece_bytes] for i in range(0, len(data), self.piece_bytes)]
        return [sum(len(c.compress(piece)) for piece in pieces) for c in self.compressors]

    def judge(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        if not text or not has_letter(text) or not self.names:
            return "und", 0.0, False
        data = plain(text)
        sizes = self.sizes(data)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        gap = (sizes[order[1]] - best) / max(1, sizes[order[1]]) if len(order) > 1 else 1.0
        score = 1.0 / sum(math.exp(max(-60.0, (best - size) * 60.0 / max(1, best))) for size in sizes)
        return self.names[order[0]], score, gap >= margin


def predict_language(
    df: DataFrame,
    dictionaries: dict[str, bytes],
    *,
    key: str = "doc_id",
    text: str = "text",
    margin: float = 0.02,
    level: int = 9,
    piece_bytes: int = 4_096,
) -> DataFrame:
    """``key``, ``lang_pred``, ``score`` and ``accepted`` of every row.

    Every piece of the text is compressed with each language's dictionary, and the
    language with the smallest sum is predicted; ``score`` is its share if each size
    weighs by its distance from the smallest. ``accepted`` is false where the next
    language is less than ``margin`` larger: the prediction is then not to be relied on.

    A null text or one without a letter gives ``und``, score 0 and not accepted, as any
    text does when nothing was learned. Ties go to the language with more learning
    rows. Repeated rows give repeated results and an empty table an empty result; other
    columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(shared.value, level, piece_bytes)
        for batch in batches:
            judged = [compressors.judge(value.as_py(), margin) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([j[0] for j in judged], pa.string()),
                    pa.array([j[1] for j in judged], pa.float64()),
                    pa.array([j[2] for j in judged], pa.bool_()),
                ],
                ["key", "lang_pred", "score", "accepted"],
            )

    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    return narrow.mapInArrow(judge, f"key {kind}, lang_pred string, score double, accepted boolean").withColumnRenamed("key", key)
