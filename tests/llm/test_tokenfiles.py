"""Token files against the tokenizers library, and the index against every key."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures import documents, words
from tokenizers import Tokenizer

from rangeload.llm import queries, tokenfiles

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("many", [0, 1, 2, 3, 100, 5000])
def test_perfect_hash(many):
    draw = np.random.default_rng(many)
    one, two = (draw.integers(0, 1 << 63, many, dtype=np.uint64) for _ in range(2))
    one[: many // 2] = 7  # the pair decides, not one of the hashes
    function = tokenfiles.PerfectHash.build(one, two)
    assert sorted(function.slots(one, two).tolist()) == list(range(many))
    assert function.slots(two, one).max(initial=-1) < max(1, many)
    assert len(function.words) * 64 <= 5 * many + 64 * 8


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError):
        tokenfiles.PerfectHash.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


def plain(rows):
    """(key, n_tokens, crc) of every document, and where each key's documents start in ascending order."""
    found = []
    for doc_id, text in rows:
        ids = ids_of(text)
        found.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return found


def check(spark, rows, folder, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = tokenfiles.write_token_files(df, PATH, f"{folder}/files", **options)
    got = files.fetch(files.keys(), ids=True).collect()
    assert sorted((str(r["key"]), r["length"], r["ids_crc32"]) for r in got) == sorted((str(k), n, c) for k, n, c in plain(rows))
    got.sort(key=lambda r: r["start"])
    keys = [r["key"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    assert [r["start"] for r in got] == [0, *np.cumsum([r["length"] for r in got])[:-1].tolist()][: len(got)]
    for r in got:
        assert len(r["ids"]) == r["length"] and r["ids"][-1] == 2
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    per_key = {}
    for r in got:
        per_key.setdefault(r["key"], []).append(r["nth"])
    assert all(nths == list(range(len(nths))) for nths in per_key.values())
    return files


def test_files(spark, folder, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BUCKET_KEYS", 16)
    rng = random.Random(3)
    rows = [(rng.randrange(1 << 40) - (1 << 39), words(rng, rng.randint(0, 60))) for _ in range(300)]
    # a key and the null key on a third of the rows, so they go on from shard to shard
    rows += [(5, words(rng, 9)) for _ in range(150)] + [(None, words(rng, 9)) for _ in range(150)] + [(6, "same")] * 40 + [(8, None)]
    files = check(spark, rows, folder, shard_bytes=4096)
    shards = files.shards().orderBy("shard").collect()
    assert len(shards) > 3 and sum(r["documents"] for r in shards) == len(rows)
    assert files.buckets > 10
    index = files.spark.read.parquet(f"{folder}/files/index").collect()
    assert len({r["bucket"] for r in index}) == len(index)
    key, text = rows[17]
    assert files.get(key) == ids_of(text)
    assert files.get(6, 39) == ids_of("same") and files.get(6, 40) is None and files.get(8) == [2]
    assert sorted(files.get(None, i) for i in (0, 149)) and files.get(None, 150) is None
    others = spark.createDataFrame([(7,), (9,), (key,), (key,), (1 << 50,)], "key long")
    assert [(r["key"], r["nth"]) for r in files.lookup(others).collect()] == [(key, 0)]
    assert [r["ids"] for r in files.fetch(others, ids=True).collect()] == [ids_of(text)]


def test_a_missing_key_is_refused(spark, folder):
    files = check(spark, [(i, f"text {i}") for i in range(0, 2000, 2)], folder)
    asked = spark.range(1, 20001, 2).withColumnRenamed("id", "key")
    assert files.lookup(asked).count() == 0


def test_payload_is_raw(spark, folder):
    df = spark.createDataFrame([(2, "b b"), (1, "a")], "doc_id long, text string")
    files = tokenfiles.write_token_files(df, PATH, f"{folder}/files")
    parts = sorted(r["path"][5:] for r in files.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/files/payload").collect())
    data = b"".join(open(part, "rb").read() for part in parts)
    ids = np.array([*ids_of("a"), *ids_of("b b")], "<u2").tobytes()
    assert files.width == 2 and (data.startswith(ids) or len(parts) > 1)


def test_wide_ids(spark, folder, monkeypatch):
    class Large:
        @staticmethod
        def from_file(path):
            return Large()

        def get_vocab_size(self):
            return 1 << 17

    monkeypatch.setattr(tokenfiles, "Tokenizer", Large)
    files = check(spark, [(i, f"text {i}") for i in range(40)], folder)
    assert files.width == 4


@pytest.mark.parametrize("clash", ["key", "shard", "offset", "nth"])
def test_query_on_odd_rows(spark, folder, clash):
    documents(spark, clash=clash).write.parquet(f"{folder}/documents.parquet")
    got = queries.op11_perfect_hash_files(spark, folder).collect()
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(k), n, c) for k, n, c in plain(rows))


def test_query_on_an_empty_table(spark, folder):
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    assert queries.op11_perfect_hash_files(spark, folder).collect() == []
