"""Tokenizer lookups word by word: a given table first, then what a worker has met."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Words of these forms skip the tokenizer's own splitting: letters of Latin-1, then a stop or comma.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
#: Words of ASCII and of letters of Latin-1, which normalisation leaves as they are but for case.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Fixed pattern: how word BPE cuts such words in small letters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
#: White space to Python, but not to the tokenizers.
_CONTROLS = re.compile("[\x1c-\x1f]")


def _byte_characters() -> list[str]:
    """The character that byte-level BPE writes for each byte: itself where it prints, else the next after 255."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(others)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()


def byte_level(text: str) -> str:
    return text if text.isascii() and " " not in text else "".join([BYTE_CHARACTERS[b] for b in text.encode()])


class WordTable(dict):
    """Words to what ``value`` makes of their ids; missing words are encoded and kept.

    Starts from ``given``. When it holds ``most`` words, it becomes the elder generation
    and starts again, taking what it meets again from there; the generation before that
    goes. So a worker's memory is bounded whatever it meets, and frequent words stay.
    """

    def __init__(self, path: str, value, given: dict, most: int = 400_000, lower: bool = False):
        super().__init__(given)
        self.given, self.most, self.value, self.lower = given, most, value, lower
        self.elder: dict = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, word: str):
        found = self.elder.get(word)
        if found is None:
            found = self.value(self._encode(word))
        if len(self) >= self.most:
            self.elder = dict(self)
            self.clear()
            self.update(self.given)
        self[word] = found
        return found

    def _encode(self, word: str) -> list[int]:
        if self.lower:
            if word.isascii() and word.isalpha():  # most are, and they are one part
                return [token.id for token in self.model.tokenize(word.lower())]
            if not _SIMPLE.fullmatch(word):
                return self.ids(word)
            tokenize = self.model.tokenize
            return [token.id for part in _PARTS.findall(word.lower()) for token in tokenize(byte_level(part))]
        if plain := _PLAIN.fullmatch(word):
            space, letters, stop = plain.groups()
            ids = [token.id for token in self.model.tokenize(byte_level(space + letters))]
            return ids + [token.id for token in self.model.tokenize(stop)] if stop else ids
        return self.ids(word)

    def ids(self, text: str) -> list[int]:
        """The library's own answer for a whole text."""
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def whole_only(self, text: str) -> bool:
        """Whether ``text`` must be encoded whole: it holds a special string, or a control Python takes for space."""
        return any(special in text for special in self.specials) or (_CONTROLS.search(text) is not None)


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


_ID_TABLES: dict[str, WordTable] = {}


def id_table(path: str, most: int) -> WordTable:
    """The table of packed ids that a worker keeps for the word BPE file at ``path``; another bound starts it anew."""
    if path not in _ID_TABLES or _ID_TABLES[path].most != most:
        _ID_TABLES.clear()
        _ID_TABLES[path] = WordTable(path, packed, {}, most, lower=True)
    return _ID_TABLES[path]


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts rows of these sizes into runs of about ``most``; a larger row is a run of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_ids(table: WordTable, texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of whole texts one after another, and where each text's ids end, for runs of the rows.

    For word BPE files that drop white space and lower all letters. A run holds about
    ``most_bytes`` of text, or one longer text. Words are told apart first, so that each is looked up
    once for a run. A null text has no ids.
    """
    texts = pc.fill_null(texts, "")
    for start, stop in _slices(pc.binary_length(texts).to_numpy(zero_copy_only=False), most_bytes):
        small = pc.ascii_lower(texts.slice(start, stop - start))  # fewer words to tell apart
        whole = np.zeros(len(small), bool)
        for special in table.specials:
            whole |= pc.match_substring(small, special).to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.if_else(pa.array(whole), "", small) if whole.any() else small)
        coded = words.flatten().dictionary_encode()
        # by way of numpy, as to_pylist makes a scalar of each word first
        each = [table[word] for word in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        flat = np.frombuffer(b"".join(each), "<u4")
        sizes = np.fromiter(map(len, each), np.int32, len(each)) >> 2
        first = np.cumsum(sizes, dtype=np.int32) - sizes
        index = coded.indices.to_numpy()
        many = sizes[index]
        ends = np.concatenate([np.zeros(1, np.int32), np.cumsum(many, dtype=np.int32)])
        place = np.repeat(first[index] - ends[:-1], many)
        place += np.arange(len(place), dtype=np.int32)
        ids = flat[place]
        offsets = words.offsets.to_numpy()
        ends = ends[offsets[1:] - offsets[0]]
        if whole.any():
            parts = np.split(ids, ends[:-1])
            for i in np.flatnonzero(whole).tolist():
                parts[i] = np.array(table.ids(texts[start + i].as_py()), np.uint32)
            ids, ends = np.concatenate(parts), np.cumsum([len(part) for part in parts])
        yield ids, ends
        pa.default_memory_pool().release_unused()


def each_text(table: WordTable, texts: pa.Array) -> Iterator[bytes]:
    """The packed ids of every text."""
    for ids, ends in text_ids(table, texts):
        data, start = ids.tobytes(), 0
        for end in ends.tolist():
            yield data[4 * start : 4 * end]
            start = end
