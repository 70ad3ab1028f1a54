"""Which tokens of two tokenizers stand for the same bytes, and how often in the whole corpus.

The tokens of a text by tokenizer A (byte-level BPE) and by tokenizer B (pieces with byte fallback) are
cut into groups at the byte offsets where tokens of both end; every A token of a group is linked to
every B token of it. A pair's count is the number of documents that hold it linked.

The counts come from inverted pair bitmaps. Documents are numbered in chunks; for a pair and a chunk there are
the compressed bitmap of the chunk's documents that hold the pair, and bit planes of how often, less
once, they do. A task gives out what it has gathered whenever that is much, so a chunk's bitmaps come in parts: they
are OR-merged, and popcounted for the numbers of documents and links. The
postings then carry the counts back: the bitmaps of a chunk, each with the count of its pair,
add it to the documents whose bits are set. No task holds all postings of a pair.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from rangeload.llm.common import written
from rangeload.llm.words import BYTE_CHARACTERS, WordTable

#: Other white space than this could be inside a piece.
_ODD_SPACE = re.compile(r"[^\S \n]")
_RUNS = re.compile(r"[ \n]{2}|[ \n]\Z|\A[ \n]")
_WORDS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Documents of a chunk; their numbers fit 16 bits.
CHUNK = 1 << 16
#: A word with more links is counted group by group.
_MANY_LINKS = 1 << 14


def word_keys(text: str) -> list[str]:
    """The words of space + ``text``, each with the white space before it unless that is one space.

    Neither tokenizer has a token that goes on from another character into a space or line feed, so the
    text can be cut there, and words are aligned by themselves. A text with other white space is one word.
    """
    if _ODD_SPACE.search(text):
        return [" " + text]
    if _RUNS.search(text):
        return [word[1:] if word[0] == " " and word[1:2].strip(" \n") else word for word in _WORDS.findall(" " + text)]
    return text.replace("\n", " \n").split(" ")


class Aligner:
    """Numbers words and aligns each of them once, until it has met ``most``, or so many characters, and forgets them all."""

    def __init__(self, a_path: str, b_path: str, most: int = 250_000, most_characters: int = 8_000_000):
        self.most, self.most_characters = most, most_characters
        self.a = WordTable(a_path, tuple, {}, most=1)
        self.a.tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        byte_of = {character: byte for byte, character in enumerate(BYTE_CHARACTERS)}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.a_many, self.b_many = 1 + max(vocabulary.values()), self.b.get_piece_size()
        self.a_bytes = [b""] * self.a_many
        for entry, at in vocabulary.items():
            self.a_bytes[at] = bytes([byte_of[c] for c in entry])
        self.b_bytes = [self._piece(at) for at in range(self.b_many)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in entries]) for entries in (self.a_bytes, self.b_bytes))
        self.texts = [f"{at}{sep}".encode() for many, sep in ((self.a_many, ","), (self.a_many, "|"), (self.b_many, ","), (self.b_many, ";")) for at in range(many)]
        self.forget()

    def _piece(self, at: int) -> bytes:
        piece = self.b.id_to_piece(at)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(at) else piece.replace("▁", " ").encode()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.characters = 0
        self.groups: list[bytes] = []
        self.whole = np.zeros(0, bool)
        self.stats = np.zeros((0, 4), np.int64)
        self.sizes, self.codes, self.links = (np.zeros(0, np.int64) for _ in range(3))

    def learn(self, words: list[str]) -> None:
        """Align ``words``, which are new, as the next numbers."""
        for at in range(0, len(words), 16_384):
            parts = self._align(words[at : at + 16_384])
            self.groups += parts[0]
            for name, part in zip(("whole", "stats", "sizes", "codes", "links"), parts[1:], strict=True):
                setattr(self, name, np.concatenate([getattr(self, name), part]))

    def _align(self, words: list[str]) -> tuple:
        """For each word the groups as text, whether its tokens give its bytes, (A tokens, B tokens, groups, links), and
        how many pairs it has; the pairs' codes; their links."""
        full = [word if word[0] in " \n" else " " + word for word in words]
        a = [self.a._encode(text) for text in full]
        b = self.b.encode([text[1:] if text[0] == " " else text for text in full], num_threads=1)
        b = [ids if text[0] == " " else ids[1:] for text, ids in zip(full, b, strict=True)]  # B has added a space before a line feed
        b = [[self.b.piece_to_id("▁")] if text == " " else ids for text, ids in zip(full, b, strict=True)]  # it adds none to nothing
        datas = [text.encode() for text in full]
        whole = np.array(
            [
                b"".join([self.a_bytes[x] for x in one]) == data and b"".join([self.b_bytes[y] for y in other]) == data
                for one, other, data in zip(a, b, datas, strict=True)
            ],
            bool,
        )
        many = len(words)
        a, b = ([ids if kept else () for ids, kept in zip(part, whole.tolist(), strict=True)] for part in (a, b))
        a_many, b_many = (np.fromiter(map(len, part), np.int64, many) for part in (a, b))
        a, b = (np.array([x for ids in part for x in ids], np.int64) for part in (a, b))
        bytes_of = np.where(whole, np.fromiter(map(len, datas), np.int64, many), 0)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_each, b_each = (np.bincount(group, minlength=len(cuts)) for group in (a_group, b_group))
        last = np.searchsorted(cuts, np.cumsum(bytes_of), side="right")  # groups up to the end of each word
        groups = np.diff(last, prepend=0)
        linked = np.concatenate([[0], np.cumsum(a_each * b_each)])
        links = linked[last] - linked[last - groups]
        word_of_a = np.repeat(np.arange(many), a_many)
        large = links > _MANY_LINKS
        # pairs of ordinary words: every A token as often as its group has B tokens
        first_b = np.cumsum(b_each) - b_each
        used = np.where(large[word_of_a], 0, b_each[a_group]) if len(a) else np.zeros(0, np.int64)
        place = np.arange(used.sum()) - np.repeat(np.cumsum(used) - used, used)
        met = np.repeat(a, used) * self.b_many + b[np.repeat(first_b[a_group], used) + place] if len(a) else np.zeros(0, np.int64)
        keyed, counts = np.unique(np.repeat(word_of_a, used) * (self.a_many * self.b_many) + met, return_counts=True)
        word, code = np.divmod(keyed, self.a_many * self.b_many)
        if large.any():
            more = []
            first_a = np.cumsum(a_each) - a_each
            for at in np.flatnonzero(large).tolist():
                pairs: Counter = Counter()
                for g in range(int(last[at] - groups[at]), int(last[at])):
                    others = Counter(b[first_b[g] : first_b[g] + b_each[g]].tolist())
                    for x, n in Counter(a[first_a[g] : first_a[g] + a_each[g]].tolist()).items():
                        for y, m in others.items():
                            pairs[x * self.b_many + y] += n * m
                more.append(np.array([(at, c, n) for c, n in pairs.items()], np.int64).reshape(-1, 3))
            word, code, counts = (np.concatenate([one, *other]) for one, other in zip((word, code, counts), zip(*[m.T for m in more], strict=True), strict=True))
            order = np.argsort(word, kind="stable")
            word, code, counts = word[order], code[order], counts[order]
        # texts of the groups: A tokens with commas and a bar, then B tokens with commas and a semicolon
        ends_a, ends_b = np.append(a_group[1:] != a_group[:-1], True)[: len(a)], np.append(b_group[1:] != b_group[:-1], True)[: len(b)]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + first_b[a_group]] = a + ends_a * self.a_many
        order[np.arange(len(b)) + np.cumsum(a_each)[b_group]] = b + 2 * self.a_many + ends_b * self.b_many
        parts = [self.texts[i] for i in order.tolist()]
        ends = np.cumsum(a_many + b_many).tolist()
        texts = [b"".join(parts[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)]
        return texts, whole, np.stack([a_many, b_many, groups, links], axis=1), np.bincount(word, minlength=many), code, counts

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the words of some texts one after another, and how many each text has."""
        if len(self.numbers) > self.most or self.characters > self.most_characters:
            self.forget()
        numbers, known = self.numbers, len(self.numbers)
        found, many = [], []
        for text in texts:
            words = word_keys(text) if text else []
            found += [numbers.setdefault(word, len(numbers)) for word in words]
            many.append(len(words))
        if len(numbers) > known:
            fresh = list(numbers)[known:]
            self.characters += sum(map(len, fresh))
            self.learn(fresh)
        return np.array(found, np.int64), np.array(many, np.int64)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


def packed_bitmap(places: np.ndarray) -> bytes:
    """A set of ascending places below ``CHUNK``: 16 bits for each, or a bit for every place if that is less."""
    if 16 * len(places) <= CHUNK:
        return places.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, np.uint8)
    bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes() + b"\0"  # an odd length tells the forms apart


def unpacked_bitmap(packed: bytes) -> np.ndarray:
    if len(packed) % 2 == 0:
        return np.frombuffer(packed, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(packed[:-1], np.uint8), bitorder="little"))


def merged_bitmap(bitmaps: list[bytes]) -> bytes:
    """The OR of some bitmaps."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    return packed_bitmap(np.unique(np.concatenate([unpacked_bitmap(b) for b in bitmaps])))


def popcount(packed: bytes) -> int:
    if len(packed) % 2 == 0:
        return len(packed) // 2
    return int(np.bitwise_count(np.frombuffer(packed[:-1], np.uint8)).sum(dtype=np.int64))


_POSTING = {"chunk": pa.int64(), "code": pa.int64(), "docs": pa.binary(), "planes": pa.list_(pa.binary())}
_DOCUMENT = {"place": pa.int32(), **dict.fromkeys(["n_a", "n_b", "n_groups", "n_links"], pa.int64()), "groups_sha256": pa.string()}


def _rows(many: int, key: pa.Array, values: dict) -> pa.RecordBatch:
    kinds = _POSTING | _DOCUMENT
    arrays = [pa.array(values[name], kind) if name in values else pa.nulls(many, kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays([key, *arrays], ["key", *kinds])


class _Gathered:
    """Postings of a chunk that were not given out yet."""

    def __init__(self):
        self.key_type, self.parts, self.many = pa.null(), [], 0

    def add(self, places: np.ndarray, codes: np.ndarray, links: np.ndarray) -> None:
        self.parts.append((codes << 16 | places, links))
        self.many += len(places)

    def give_out(self, chunk: int) -> Iterator[pa.RecordBatch]:
        if not self.many:
            return
        keys, links = (np.concatenate(part) for part in zip(*self.parts, strict=True))
        self.parts, self.many = [], 0
        order = np.argsort(keys)
        keys, more = keys[order], links[order] - 1
        places, codes = keys & (CHUNK - 1), keys >> 16
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        most = np.maximum.reduceat(more, first).tolist()
        ends = [*first[1:].tolist(), len(codes)]
        docs, planes = [], []
        for start, end, high in zip(first.tolist(), ends, most, strict=True):
            some, extra = places[start:end], more[start:end]
            docs.append(packed_bitmap(some))
            planes.append([packed_bitmap(some[extra >> bit & 1 == 1]) for bit in range(high.bit_length())] if high else [])
        for low in range(0, len(docs), 8192):
            part = slice(low, low + 8192)
            many = len(docs[part])
            values = {"chunk": [chunk] * many, "code": codes[first[part]], "docs": docs[part], "planes": planes[part]}
            yield _rows(many, pa.nulls(many, self.key_type), values)


_ALIGNERS: dict = {}


def _post(a_path: str, b_path: str, most_postings: int, slice_chars: int = 2 << 20):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (a_path, b_path) not in _ALIGNERS:
            _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
        aligner = _ALIGNERS[a_path, b_path]
        chunk, place = TaskContext.get().partitionId() << 24, 0
        gathered = _Gathered()
        for batch in batches:
            texts, gathered.key_type = batch.column(1), batch.schema.field(0).type
            start = 0
            while start < len(texts):
                some, chars = [], 0
                while start + len(some) < len(texts) and place + len(some) < CHUNK and chars < slice_chars:
                    some.append(texts[start + len(some)].as_py() or "")
                    chars += len(some[-1])
                yield _documents(aligner, some, batch.column(0).slice(start, len(some)), chunk, place, gathered)
                start, place = start + len(some), place + len(some)
                if gathered.many > most_postings or place == CHUNK:
                    yield from gathered.give_out(chunk)
                if place == CHUNK:
                    chunk, place = chunk + 1, 0
        yield from gathered.give_out(chunk)

    return post


def _documents(aligner: Aligner, texts: list[str], keys: pa.Array, chunk: int, place: int, gathered: _Gathered) -> pa.RecordBatch:
    """Rows of some documents; their postings are gathered."""
    numbers, many = aligner.number(texts)
    ends = np.cumsum(many)
    doc = np.repeat(np.arange(len(texts)), many)
    lost = np.bincount(doc[~aligner.whole[numbers]], minlength=len(texts)) > 0
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(aligner.stats[numbers], axis=0)])
    stats = np.where(lost[:, None], 0, sums[ends] - sums[ends - many])
    shas = []
    groups = aligner.groups
    for at, (s, e) in enumerate(zip((ends - many).tolist(), ends.tolist(), strict=True)):
        text = b"" if lost[at] else b"".join([groups[i] for i in numbers[s:e].tolist()])[:-1]
        shas.append(hashlib.sha256(text).hexdigest() if text else "")
    kept = ~lost[doc]
    words = len(aligner.sizes)
    pairs, times = np.unique(doc[kept] * words + numbers[kept], return_counts=True)
    of, word = np.divmod(pairs, words)
    sizes = aligner.sizes[word]
    first = (np.cumsum(aligner.sizes) - aligner.sizes)[word]
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    space = aligner.a_many * aligner.b_many
    found, links = _summed(np.repeat(of, sizes) * space + aligner.codes[at], np.repeat(times, sizes) * aligner.links[at])
    of, codes = np.divmod(found, space)
    gathered.add(of + place, codes, links)
    values = {"chunk": [chunk] * len(texts), "place": np.arange(place, place + len(texts)), "groups_sha256": shas}
    values |= dict(zip(("n_a", "n_b", "n_groups", "n_links"), stats.T, strict=True))
    return _rows(len(texts), keys, values)


_MERGED = {"code": pa.int64(), "chunk": pa.int64(), "docs": pa.binary(), "planes": pa.list_(pa.binary()), "documents": pa.int64(), "links": pa.int64()}


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by pair and chunk, one row for each, with popcounts."""

    def merged(rows: list[tuple]) -> pa.RecordBatch:
        made = []
        for (code, chunk), docs, planes in rows:
            docs = merged_bitmap(docs)
            depth = max(map(len, planes))
            planes = [merged_bitmap([p[bit] for p in planes if bit < len(p)]) for bit in range(depth)]
            documents = popcount(docs)
            made.append((code, chunk, docs, planes, documents, documents + sum(popcount(p) << bit for bit, p in enumerate(planes))))
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*made, strict=True), _MERGED.values(), strict=True)], list(_MERGED))

    rows: list[tuple] = []
    for batch in batches:
        for code, chunk, docs, planes in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if not rows or rows[-1][0] != (code, chunk):
                if len(rows) == 4096:
                    yield merged(rows)
                    rows = []
                rows.append(((code, chunk), [], []))
            rows[-1][1].append(docs)
            rows[-1][2].append(planes)
    if rows:
        yield merged(rows)


def _return(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings with their pairs' scores, sorted by chunk, to (``chunk, place, n_best, count_sum``)."""
    current, best, total = None, None, None

    def sums() -> pa.RecordBatch:
        places = np.flatnonzero(total)
        arrays = [np.full(len(places), current), places.astype(np.int32), best[places], total[places]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["chunk", "place", "n_best", "count_sum"])

    for batch in batches:
        for chunk, docs, planes, count, is_best in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if chunk != current:
                if current is not None:
                    yield sums()
                current, best, total = chunk, np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
            for worth, bitmap in [(1, docs), *[(1 << bit, plane) for bit, plane in enumerate(planes)]]:
                places = unpacked_bitmap(bitmap)
                total[places] += worth * count
                if is_best:
                    best[places] += worth
    if current is not None:
        yield sums()


@dataclass(frozen=True)
class Alignment:
    """An aligned corpus: a row for each document, and the merged bitmaps of every pair and chunk, both written."""

    documents: DataFrame
    postings: DataFrame
    b_many: int

    def counts(self) -> DataFrame:
        """``a``, ``b``, the ``documents`` that hold the pair linked, and the ``links`` of it in all."""
        sums = self.postings.groupBy("code").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
        return sums.select(F.floor(F.col("code") / self.b_many).alias("a"), (F.col("code") % self.b_many).alias("b"), "documents", "links")

    def scored(self) -> DataFrame:
        """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every document."""
        counts = self.counts().select((F.col("a") * self.b_many + F.col("b")).alias("code"), "a", F.col("documents").alias("count"))
        counts = written(counts, "pair-counts")
        highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
        scores = counts.join(highest, "a").select("code", "count", (F.col("count") == F.col("highest")).alias("best"))
        carried = self.postings.select("code", "chunk", "docs", "planes").join(scores, "code")
        dealt = carried.repartition("chunk").sortWithinPartitions("chunk").select("chunk", "docs", "planes", "count", "best")
        sums = dealt.mapInArrow(_return, "chunk long, place int, n_best long, count_sum long")
        joined = self.documents.join(sums, ["chunk", "place"], "left")
        zero = [F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("n_best", "count_sum")]
        return joined.select("key", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def align_documents(
    df: DataFrame, a_path: str, b_path: str, *, key: str = "doc_id", text: str = "text", most_postings: int = 2_000_000
) -> Alignment:
    """Align the tokens of every text of ``df`` by the byte-level BPE file ``a_path`` and the piece model ``b_path``.

    A encodes a space and the text, B the text, before which it sets a space; special strings inside texts are plain
    text. A text that is null or empty, or whose tokens' bytes differ from space + text by A or by B, has
    no tokens: its numbers are 0 and its ``groups_sha256`` is ''. Otherwise that is the sha256 of its groups,
    ``a1,a2|b1;a3|b2,b3``. Every row is a document: rows with one key, or repeated rows, count by
    themselves; a null key stays. An empty table gives empty results; other columns are not read.

    Each text is encoded once, word by word, in a cache that the worker keeps; neither texts nor tokens are shuffled,
    but one row for each pair and chunk (up to 65,536 documents of a task). A task gives
    out bitmaps whenever it has gathered ``most_postings``.
    """
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, chunk long, code long, docs binary, planes array<binary>, place int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    posted = written(narrow.mapInArrow(_post(a_path, b_path, most_postings), schema), "postings")
    documents = posted.where("place is not null").drop("code", "docs", "planes")
    parts = posted.where("code is not null").select("code", "chunk", "docs", "planes")
    parts = parts.repartition("code", "chunk").sortWithinPartitions("code", "chunk")
    merged = parts.mapInArrow(_merge, "code long, chunk long, docs binary, planes array<binary>, documents long, links long")
    pieces = SentencePieceProcessor(model_file=b_path).get_piece_size()
    return Alignment(documents, written(merged, "merged-postings"), pieces)
