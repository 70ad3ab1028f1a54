"""Token ids in raw shard files with a minimal perfect hash index over the document keys.

A shard file has the ids of its documents one after another, each with the end id behind, as
little-endian unsigned integers of 16 bits if all ids of the vocabulary fit, else 32. Behind them
is a footer of 64-bit integers, keys and lengths of the documents, then how many of them
have no key, how many there are, and how many ids, and the end id once more. Documents ascend
by key through a shard and from shard to shard. Spark's own writer makes the files, so
a task that is repeated leaves one file.

The index is split by a hash of the key into buckets that fit a task. Each has a minimal
perfect hash function made of bit levels: a key's bit on a level is set if it is the only one there,
and those that meet go on to the next level; the rank of its bit is a key's slot. A slot
keeps a fingerprint of the key, so that others are refused, and the shard, offset and
length of the document. A lookup takes a few bits and one slot, however many documents there are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rangeload.llm.words import id_table, text_ids

#: Of the splitmix64 generator.
_STEP, _MIX1, _MIX2 = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: About this many keys are in a bucket.
BUCKET_KEYS = 16_384


def _mixed(values: np.ndarray, turn: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = values + _STEP * np.uint64(turn + 1)
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash function of keys that are given as two 64-bit hashes each."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        counts = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, one: np.ndarray, two: np.ndarray) -> PerfectHash:
        """``one`` and ``two`` are unsigned; no pair of them may repeat."""
        sizes, words = [], []
        while len(one):
            if len(sizes) == 64:
                raise ValueError("keys repeat")
            size = 64 * -(-2 * len(one) // 64)  # two bits a key
            at = cls._place(one, two, len(sizes), size)
            met = np.bincount(at, minlength=size)
            sizes.append(size)
            words.append(np.packbits(met == 1, bitorder="little").view("<u8"))
            rest = met[at] > 1
            one, two = one[rest], two[rest]
        return cls(sizes, np.concatenate(words) if words else np.zeros(0, "<u8"))

    @staticmethod
    def _place(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
        return ((_mixed(one, level) ^ _mixed(two, level + 64)) % np.uint64(size)).astype(np.int64)

    def slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The slot of each key, from 0 without gaps; -1 for some of the keys that were not given, any for others."""
        slots = np.full(len(one), -1, np.int64)
        left, start = np.arange(len(one)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = start + self._place(one[left], two[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            there = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slots[left[there]] = (self.before[at >> 6] + below)[there]
            left, start = left[~there], start + size
        return slots


def _hashes(key: str = "key", nth: str = "nth") -> list[Column]:
    """Two hashes of a key and of which of the documents with this key is meant."""
    known = F.col(key).isNotNull()
    return [F.xxhash64(known, key, nth).alias("one"), F.xxhash64(F.lit(7), nth, known, key).alias("two")]


_ADDRESSES = {"shards": "<u4", "offsets": "<u8", "lengths": "<u8"}


class TokenFiles:
    """The files in ``folder``, as :func:`write_token_files` leaves them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        about = spark.read.parquet(f"{folder}/about").first()
        self.width, self.end_id, self.buckets = about["width"], about["end_id"], about["buckets"]

    def shards(self) -> DataFrame:
        """One row for each shard: number, file, documents, ids, ids in all shards before, and the footer."""
        shards = self.spark.read.parquet(f"{self.folder}/shards")
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a number for each shard
        first = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
        return shards.join(first, "shard")

    def keys(self) -> DataFrame:
        """``key`` and ``nth`` (from 0, among documents of one key) of every document."""
        return _documents(self.spark.read.parquet(f"{self.folder}/shards")).select("key", "nth")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """``key``, ``nth``, ``shard``, ``offset`` and ``length`` of those ``keys`` that are in the index.

        ``keys`` has ``key`` and, if others than the first document of a key are wanted, ``nth``;
        null is a key. Rows of ``keys`` that repeat are looked up and returned once.
        """
        if "nth" not in keys.columns:
            keys = keys.withColumn("nth", F.lit(0))
        wanted = keys.select(F.col("key").cast("long"), F.col("nth").cast("long")).distinct().select("key", "nth", *_hashes())
        wanted = wanted.withColumn("bucket", _bucket(self.buckets)).withColumn("asked", F.lit(True))
        index = self.spark.read.parquet(f"{self.folder}/index").withColumn("asked", F.lit(False))
        met = wanted.unionByName(index, allowMissingColumns=True).repartition("bucket").sortWithinPartitions("bucket", "asked")
        names = ["key", "nth", "one", "two", "asked", "bucket", "sizes", "words", "prints", *_ADDRESSES]
        return met.select(*names).mapInArrow(_look_up, "key long, nth long, shard int, offset long, length long")

    def fetch(self, keys: DataFrame, ids: bool = False) -> DataFrame:
        """The documents of ``keys`` (see :meth:`lookup`), read from the payloads at the addresses that the index has.

        Columns ``key``, ``nth``, ``start`` (ids of all documents before), ``length`` (with the end id), ``ids_crc32``
        of the ids as unsigned 32-bit integers, and ``ids`` if asked for.
        """
        found = self.lookup(keys)
        read = _payload(self.spark, self.folder).mapInArrow(_records(self.width, ids), "shard int, offset long, size long, ids_crc32 long" + ", ids array<long>" * ids)
        met = found.join(read, (found["shard"] == read["shard"]) & (found["offset"] == read["offset"]) & (found["length"] == read["size"]))
        met = met.select("key", "nth", found["shard"], found["offset"], "length", "ids_crc32", *["ids"] * ids)
        firsts = self.shards().select("shard", "first")
        return met.join(firsts, "shard").select("key", "nth", (F.col("first") + F.col("offset")).alias("start"), "length", "ids_crc32", *["ids"] * ids)

    def get(self, key: int | None, nth: int = 0) -> list[int] | None:
        """The ids of one document, with the end id, from one row of the index and one shard; None if there is none."""
        asked = self.spark.createDataFrame([(key, nth)], "key long, nth long")
        bucket = asked.select(*_hashes()).select(_bucket(self.buckets).alias("bucket")).first()["bucket"]
        index = self.spark.read.parquet(f"{self.folder}/index").where(F.col("bucket") == bucket).first()
        one, two = (np.array([h], np.int64).view(np.uint64) for h in asked.select(*_hashes()).first())
        address = _addresses(index.asDict() if index else None, one, two)
        if address["shard"][0] < 0:
            return None
        name = self.spark.read.parquet(f"{self.folder}/shards").where(F.col("shard") == int(address["shard"][0])).first()["file"]
        content = self.spark.read.format("binaryFile").load(f"{self.folder}/payload/{name}").first()["content"]
        start, length = int(address["offset"][0]), int(address["length"][0])
        return np.frombuffer(content, f"<u{self.width}", length, start * self.width).tolist()


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("one"), F.lit(buckets)).cast("int")


def _payload(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/payload")
    return files.select("path", "content")


def _shard_of(path: str) -> tuple[int, str]:
    name = path.rsplit("/", 1)[-1]
    return int(re.match(r"part-(\d+)-", name)[1]), name


def _footer(content: memoryview, width: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Keys, lengths, documents without a key and ids of a shard."""
    nulls, many, ids = np.frombuffer(content, "<i8", 3, len(content) - width - 24).tolist()
    at = len(content) - width - 24 - 16 * many
    return np.frombuffer(content, "<i8", many, at), np.frombuffer(content, "<i8", many, at + 8 * many), nulls, ids


def _footers(width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                shard, name = _shard_of(path.as_py())
                keys, lengths, nulls, ids = _footer(memoryview(content.as_buffer()), width)
                ends = [(None if at < nulls else int(keys[at])) if len(keys) else None for at in (0, -1 % max(1, len(keys)))]
                counts = [nulls if end is None else int((keys[nulls:] == end).sum()) for end in ends]
                values = [shard, name, len(keys), ids, nulls, ends[0], counts[0], ends[1], counts[1], keys.tobytes(), lengths.tobytes()]
                kinds = [pa.int32(), pa.string(), *[pa.int64()] * 7, pa.binary(), pa.binary()]
                names = ["shard", "file", "documents", "ids", "nulls", "first_key", "first_many", "last_key", "last_many", "keys", "lengths"]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    return read


_SHARDS = (
    "shard int, file string, documents long, ids long, nulls long, first_key long, first_many long, last_key long, last_many long, "
    "keys binary, lengths binary"
)


def _documents(shards: DataFrame) -> DataFrame:
    """``key, nth, shard, offset, length`` of every document, from the footers."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, nulls, keys, lengths in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                keys, lengths = np.frombuffer(keys, "<i8"), np.frombuffer(lengths, "<i8")
                place = np.arange(len(keys))
                fresh = np.concatenate([place[:1] == 0, (keys[1:] != keys[:-1]) | (place[1:] == nulls)])
                nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64(), mask=place < nulls),
                        pa.array(nth, pa.int64()),
                        pa.array(np.full(len(keys), shard, np.int32)),
                        pa.array(np.cumsum(lengths) - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                    ],
                    ["key", "nth", "shard", "offset", "length"],
                )

    rows = shards.where("documents > 0")
    documents = rows.select("shard", "nulls", "keys", "lengths").mapInArrow(unpack, "key long, nth long, shard int, offset long, length long")
    # a key that goes on from one shard to the next is the last of the one and the first of the other
    ends = rows.select("shard", F.col("first_key").alias("key"), F.col("first_many").alias("many")).union(
        rows.where("not (first_key <=> last_key)").select("shard", "last_key", "last_many")
    )
    before = Window.partitionBy("key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    past = ends.withColumn("past", F.sum("many").over(before)).where("past > 0")
    past = past.select(F.col("shard").alias("in"), F.col("key").alias("of"), "past")
    same = (F.col("shard") == F.col("in")) & F.col("key").eqNullSafe(F.col("of"))
    return documents.join(past, same, "left").select("key", (F.col("nth") + F.coalesce("past", F.lit(0))).alias("nth"), "shard", "offset", "length")


_INDEX = "bucket int, sizes array<long>, words binary, prints binary, shards binary, offsets binary, lengths binary"


def _build_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows from documents sorted by bucket."""

    def built(bucket: int, parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        one, two, *values = (np.concatenate(part) for part in zip(*parts, strict=True))
        one, two = one.view(np.uint64), two.view(np.uint64)
        function = PerfectHash.build(one, two)
        order = np.argsort(function.slots(one, two))
        row = {"bucket": bucket, "sizes": function.sizes, "words": function.words.tobytes()}
        row["prints"] = two[order].astype("<u4").tobytes()
        row |= {name: value[order].astype(kind).tobytes() for (name, kind), value in zip(_ADDRESSES.items(), values, strict=True)}
        kinds = [pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

    current, parts = None, []
    for batch in batches:
        buckets, *columns = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        cuts = np.flatnonzero(np.diff(buckets)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
            if low == high:
                continue
            if current is not None and current != buckets[low]:
                yield built(current, parts)
                parts = []
            current = int(buckets[low])
            parts.append([column[low:high] for column in columns])
    if parts:
        yield built(current, parts)


def _addresses(row: dict | None, one: np.ndarray, two: np.ndarray) -> dict[str, np.ndarray]:
    """Shard (-1: not in the index), offset and length for each key."""
    if row is None:
        return {name: np.full(len(one), -1, np.int64) for name in ("shard", "offset", "length")}
    slots = PerfectHash(list(row["sizes"]), np.frombuffer(row["words"], "<u8")).slots(one, two)
    prints = np.frombuffer(row["prints"], "<u4")
    found = (slots >= 0) & (prints[slots] == two.astype(np.uint32))
    return {name[:-1]: np.where(found, np.frombuffer(row[name], kind)[slots].astype(np.int64), -1) for name, kind in _ADDRESSES.items()}


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Addresses of keys that follow the index row of their bucket."""
    bucket, row = None, None
    for batch in batches:
        asked, buckets = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("asked", "bucket"))
        cuts = np.flatnonzero((np.diff(buckets) != 0) | ~asked[1:] | ~asked[:-1]) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(buckets)], strict=True):
            if low == high:
                continue
            if not asked[low]:
                row = {name: batch.column(name)[low].as_py() for name in ("sizes", "words", "prints", *_ADDRESSES)}
                bucket = buckets[low]
                continue
            some = batch.slice(low, high - low)
            one, two = (some.column(name).to_numpy().view(np.uint64) for name in ("one", "two"))
            address = _addresses(row if bucket == buckets[low] else None, one, two)
            found = pa.array(address["shard"] >= 0)
            arrays = [some.column("key"), some.column("nth"), pa.array(address["shard"].astype(np.int32)), pa.array(address["offset"]), pa.array(address["length"])]
            yield pa.RecordBatch.from_arrays([array.filter(found) for array in arrays], ["key", "nth", "shard", "offset", "length"])


def _records(width: int, ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                content = memoryview(content.as_buffer())
                _, lengths, _, _ = _footer(content, width)
                ends = np.cumsum(lengths)
                for low in range(0, len(lengths), 4096):
                    some = lengths[low : low + 4096]
                    first = int(ends[low] - lengths[low])
                    wide = np.frombuffer(content, f"<u{width}", int(some.sum()), first * width).astype("<u4")
                    data, at = memoryview(wide).cast("B"), (ends[low : low + 4096] - first).tolist()
                    crcs = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip([0, *at[:-1]], at, strict=True)]
                    arrays = [
                        pa.array(np.full(len(some), _shard_of(path.as_py())[0], np.int32)),
                        pa.array(ends[low : low + 4096] - some),
                        pa.array(some),
                        pa.array(crcs, pa.int64()),
                    ]
                    if ids:
                        arrays.append(pa.ListArray.from_arrays(pa.array([0, *at], pa.int32()), pa.array(wide.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(arrays, ["shard", "offset", "size", "ids_crc32", "ids"][: len(arrays)])

    return read


def _encoder(path: str, width: int, most_words: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = id_table(path, most_words)
        keys, lengths, nulls = [], [], 0
        for batch in batches:
            nulls += batch.column(0).null_count
            keys.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
            for ids, ends in text_ids(words, batch.column(1)):
                many = np.diff(ends, prepend=0)
                lengths.append(many + 1)
                offsets = np.concatenate([[0], ends * width]).astype(np.int32)
                data = pa.py_buffer(ids.astype(f"<u{width}").tobytes())
                yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(offsets.tobytes()), data])], ["value"])
        keys, lengths = (np.concatenate(some) if some else np.zeros(0) for some in (keys, lengths))
        tail = np.array([nulls, len(keys), int(lengths.sum())], "<i8")
        footer = b"".join(part.astype("<i8").tobytes() for part in (keys, lengths, tail))
        yield pa.RecordBatch.from_arrays([pa.array([footer], pa.binary())], ["value"])

    return encode


def write_token_files(
    df: DataFrame,
    path: str,
    folder: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_bytes: int = 32 << 20,
    most_words: int = 250_000,
) -> TokenFiles:
    """Write the ids of every text of ``df``, by the word BPE file at ``path``, with their index, to ``folder``.

    ``shard_bytes`` of ``df``, as it is stored, make a shard, less in a small table so that it has several. Texts are shuffled
    once, by ranges of key (then of a hash of the text and the row's place, so that rows of one
    key are spread over shards too), and encoded in order as they are written. Keys are integers and need not be unique.

    A null text has no ids but the end id. A null key is a key, before all others; rows with one key
    come in the order of their texts' hashes. Repeated rows are documents of their own, an empty
    table gives files without documents, and other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, size // shard_bytes, min(least, size >> 20)) if size < 1 << 60 else least
    by = ["key", "hash", "place"]
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(shards, *by).sortWithinPartitions(*by).select("key", "text")
    width = 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4
    end = end_id.to_bytes(width, "little").decode("latin-1")
    values = rows.mapInArrow(_encoder(path, width, most_words), "value binary").select(F.col("value").cast("string"))
    # each row is followed by the separator, which is the end id
    values.write.option("lineSep", end).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 0).text(f"{folder}/payload")
    _payload(spark, folder).mapInArrow(_footers(width), _SHARDS).write.parquet(f"{folder}/shards")
    footers = spark.read.parquet(f"{folder}/shards")
    many = footers.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, many // BUCKET_KEYS)
    documents = _documents(footers).select("*", *_hashes()).withColumn("bucket", _bucket(buckets))
    sorted_rows = documents.repartition("bucket").sortWithinPartitions("bucket")
    index = sorted_rows.select("bucket", "one", "two", "shard", "offset", "length").mapInArrow(_build_index, _INDEX)
    index.write.parquet(f"{folder}/index")
    about = spark.createDataFrame([(width, end_id, buckets)], "width int, end_id int, buckets int")
    about.coalesce(1).write.parquet(f"{folder}/about")
    return TokenFiles(spark, folder)
