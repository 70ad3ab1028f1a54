"""Alignment and pair counts against a version that encodes whole texts and counts in dictionaries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, words
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from rangeload.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = Tokenizer.from_file(A)
TOKENIZER.encode_special_tokens = True
PIECES = SentencePieceProcessor(model_file=B)
BYTE_OF = {c: b for b, c in enumerate(alignment.BYTE_CHARACTERS)}


def groups_of(text):
    """Groups ((A ids), (B ids)) of a whole text; none if the bytes differ."""
    if not text:
        return []
    one = TOKENIZER.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(BYTE_OF[c] for c in token)) for i, token in zip(one.ids, one.tokens)]
    b = []
    for i in PIECES.encode(text):
        piece = PIECES.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    ends = [set(np.cumsum([len(x) for _, x in part]).tolist()) for part in (a, b)]
    found = []
    at = [0, 0]
    place = [0, 0]
    for end in sorted(ends[0] & ends[1]):
        group = []
        for side, part in enumerate((a, b)):
            ids = []
            while place[side] < end:
                ids.append(part[at[side]][0])
                place[side] += len(part[at[side]][1])
                at[side] += 1
            group.append(ids)
        found.append(group)
    return found


def plain(rows):
    aligned = [(doc_id, groups_of(text)) for doc_id, text in rows]
    links = [Counter((x, y) for one, other in groups for x in one for y in other) for _, groups in aligned]
    count = Counter(pair for found in links for pair in found)
    highest = Counter()
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    result = []
    for (doc_id, groups), found in zip(aligned, links):
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, other)) for one, other in groups)
        result.append(
            (
                str(doc_id),
                sum(len(one) for one, _ in groups),
                sum(len(other) for _, other in groups),
                len(groups),
                sum(found.values()),
                sum(n for pair, n in found.items() if count[pair] == highest[pair[0]]),
                sum(n * count[pair] for pair, n in found.items()),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(result), count, sum(links, Counter())


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    aligned = alignment.align_documents(df, A, B, **options)
    want, count, links = plain(rows)
    got = aligned.scored().collect()
    assert sorted((str(r["key"]), *[r[name] for name in NAMES]) for r in got) == want
    assert {(r["a"], r["b"]): (r["documents"], r["links"]) for r in aligned.counts().collect()} == {pair: (n, links[pair]) for pair, n in count.items()}
    return aligned


def test_words(spark):
    rng = random.Random(5)
    rows = [(i, words(rng, rng.randint(0, 40)).replace("e", rng.choice(["é", "e", "'s "]))) for i in range(200)]
    rows += [(None, "a a a the the b. 12,345 don't"), (3, "tokenization, untokenizable; mis-aligned")] * 3
    check(spark, rows)


def test_bitmaps_in_parts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "_MANY_LINKS", 4)
    rng = random.Random(6)
    aligned = check(spark, [(i, words(rng, 30)) for i in range(150)], most_postings=100)
    assert aligned.postings.groupBy("code", "chunk").count().where("count > 1").count() == 0


SPACES = ["  ", " \n", "\n\n\n", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "\0", " ", " "]


def test_odd_characters(spark):
    rng = random.Random(7)
    parts = ["a", "Word", "x.", "▁", "<s>", "<|endoftext|>", "<0x0A>", "\U0001f600", "é", "ﬁ", "​", "''", "12", "'s", "日本", *SPACES, *SPACES]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(1, 9)))) for i in range(400)]
    rows += [(1000 + i, s + "x" + s + s + "y" + s) for i, s in enumerate(SPACES)]
    check(spark, rows)


def test_long_texts(spark):
    check(spark, [(1, "long " * 60_000), (2, "a" * 30_000), (3, "ÿ" * 5_000), (4, " " * 3_000), (5, "xy\n" * 3_000 + "z")])


def test_bitmap_forms():
    for places in ([], [0], [5, 65_535], range(4096), range(5000), range(0, 65_536, 3)):
        places = np.array(list(places), np.int64)
        packed = alignment.packed_bitmap(places)
        assert alignment.unpacked_bitmap(packed).tolist() == places.tolist() and alignment.popcount(packed) == len(places)
        assert len(packed) <= 8193
        more = alignment.packed_bitmap(np.arange(7, 6000, 2))
        assert alignment.unpacked_bitmap(alignment.merged_bitmap([packed, more])).tolist() == sorted({*places.tolist(), *range(7, 6000, 2)})


@pytest.mark.parametrize("clash", ["key", "chunk", "a", "code"])
def test_query_on_odd_rows(spark, folder, clash):
    documents(spark, clash=clash).write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_pair_bitmaps(spark, folder).collect()
    want = plain([(r["doc_id"], r["text"]) for r in documents(spark).collect()])[0]
    assert sorted((str(r["doc_id"]), *[r[name] for name in NAMES]) for r in got) == want


def test_query_on_an_empty_table(spark, folder):
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    assert queries.op13_pair_bitmaps(spark, folder).collect() == []


def test_a_worker_forgets():
    aligner = alignment.Aligner(A, B, most=50, most_characters=400)
    rng = random.Random(8)
    for _ in range(30):
        texts = [words(rng, 20), "a tab\t" * 40, None]
        numbers, many = aligner.number(texts)
        assert many.tolist() == [20, 1, 0] and len(aligner.sizes) == len(aligner.numbers) == len(aligner.groups)
        assert len(aligner.numbers) <= 50 + 21 and aligner.characters <= 400 + 400
        assert aligner.stats[numbers[20]].tolist()[2] == len(groups_of(texts[1]))
