"""Registered queries without SQL, and the stages of the pipeline, against plain versions on a small folder."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from fixtures import documents, words
from test_linededup import plainly
from test_neardup import edited, groups
from test_simhash import plain_print
from tokenizers import Tokenizer

import corpus_pipeline
from rangeload.llm import language, queries
from rangeload.llm.mixing import cycle_slots, tempered_parts
from rangeload.llm.quality import fit_quality

WORD = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
BYTE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows_of_folder():
    rng = random.Random(21)
    shared = "one long line that is certainly found in many of the documents here"
    texts = [words(rng, rng.randint(0, 120)) for _ in range(50)]
    texts += [text + "\n" + shared for text in texts[:9]] + [edited(rng, words(rng, 200), n) for n in (0, 1, 2)] + [texts[3].upper(), texts[4] + " x", "½ ²", "", "  ", "!!!"]
    long = words(rng, 3000)
    texts += [long, edited(rng, long, 3), None, "<|endoftext|> a", "ÀB ç"]
    return [(i, text, rng.choice(["en", "de"]), f"s{i % 4}", len(text or "")) for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = rows_of_folder()
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 5 > 0), 0) for i, *_ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, {r[0]: r for r in rows}


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_op2(spark, tables):
    folder, rows = tables
    made = queries.op2_hypergeometric_shards(spark, folder).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in made) == sorted(
        (i, len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for i, r in rows.items()
    )
    slots = [sorted(r["slot"] for r in made if r["shard"] == s) for s in range(24)]
    assert all(found == list(range(len(found))) for found in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1


def test_op3(spark, tables):
    folder, rows = tables
    made = {r["doc_id"]: r for r in queries.op3_byte_network_quality(spark, folder).collect()}
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    learned = [i for i in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    network = fit_quality(docs.where(docs["doc_id"].isin(learned)), labels)
    tables_ = network.paired()
    for i, row in rows.items():
        summary = network.summary((row[1] or "").encode(), tables_)
        assert made[i]["held_out"] == (i not in learned) and 0 <= made[i]["score"] <= 1
        assert made[i]["predicted"] == int(made[i]["score"] >= 0.5) and len(summary) == 4
    assert made.keys() == rows.keys()


def test_op4(spark, tables):
    folder, rows = tables
    made = queries.op4_best_fit_packing(spark, folder).collect()
    expected = []
    for i, row in rows.items():
        ids = [*WORD.encode(row[1] or "", add_special_tokens=False).ids, 0]
        expected += [(i, n, s, len(ids[s : s + 2048]), zlib.crc32(packed(ids[s : s + 2048]))) for n, s in enumerate(range(0, len(ids), 2048))]
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in made) == sorted(expected)
    bins = {}
    for r in sorted(made, key=lambda r: r["offset"]):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 2048 and len(bins) <= -(-sum(r["length"] for r in made) // 2048) + 1


def test_op5(spark, tables):
    folder, rows = tables
    made = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in queries.op5_two_tier_token_counts(spark, folder).collect()}
    many = {i: len(BYTE.encode(row[1] or "", add_special_tokens=False).ids) for i, row in rows.items()}
    assert made == {i: (len((row[1] or "").encode()), many[i], many[i] > 512) for i, row in rows.items()}


def test_op8(spark, folder):
    draw = np.random.default_rng(2)
    vectors = [draw.normal(size=16) for _ in range(40)]
    vectors += [v + 0.1 * draw.normal(size=16) for v in vectors[:12]] + [vectors[0], np.zeros(16)]
    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(vectors)] + [(100, None, 0), (101, [float("nan")] * 16, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    units = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows if v and np.isfinite(v).all() and any(v)}
    near = {i: [j for j in units if i in units and i != j and units[i] @ units[j] >= 0.9] for i, *_ in rows}
    least = {i: i for i in near}
    for _ in rows:
        for i, others in near.items():
            for j in others:
                least[i] = least[j] = min(least[i], least[j])
    made = queries.op8_quantised_near_duplicates(spark, folder).collect()
    assert {tuple(r) for r in made} == {(i, len(near[i]), least[i], least[i] == i) for i in near}


def test_op9(spark, tables):
    """Sizes by a compressor of each language, made here."""
    folder, rows = tables
    made = {r["doc_id"]: r for r in queries.op9_compression_language(spark, folder).collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    contents = language.learn_dictionaries(docs.where(~docs["doc_id"].isin([i for i in rows if held_out[i]])))
    dictionaries = {name: zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for name, data in contents.items()}
    for i, (_, text, *_) in rows.items():
        assert made[i]["held_out"] == held_out[i]
        if not any(c.isalpha() for c in text or ""):
            assert (made[i]["lang_pred"], made[i]["score"]) == ("und", 0.0)
            continue
        kept = "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() else " " for c in text)
        data = " ".join(kept.split(" ")).encode()
        data = b" ".join(data.split())
        sizes = {}
        for name, content in dictionaries.items():
            options = {"dict_data": content, "level": 9, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
            sizes[name] = sum(len(zstandard.ZstdCompressor(**options).compress(data[at : at + 4096])) for at in range(0, len(data), 4096))
        assert sizes[made[i]["lang_pred"]] == min(sizes.values()) and 0 <= made[i]["score"] <= 1


def test_op10(spark, tables):
    folder, rows = tables
    prints = {i: plain_print(row[1]) for i, row in rows.items()}
    least = {i: i for i in rows}
    for _ in range(6):
        for i in rows:
            for j in rows:
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    least[i] = least[j] = min(least[i], least[j])
    made = queries.op10_simhash_near_duplicates(spark, folder).collect()
    assert {tuple(r) for r in made} == {(i, f"{prints[i]:016x}", least[i]) for i in rows}


def test_stages(spark, tables):
    """Rows and texts of every stage, from what the one before is given."""
    folder, rows = tables
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in _scored(spark, docs, folder)}
    judged = stages["quality classifier"](spark, docs, folder)
    assert {tuple(r) for r in judged.collect()} == {row for i, row in rows.items() if scores[i] >= 0.5}
    lines = stages["line dedup"](spark, docs, folder)
    kept = {i: text for i, text, *_ in plainly([(i, row[1]) for i, row in rows.items()])}
    assert {tuple(r) for r in lines.collect()} == {(i, kept[i], *row[2:4], len(kept[i])) for i, row in rows.items()}
    assert sum(kept[i] != (row[1] or "") for i, row in rows.items()) == 8
    single = stages["SimHash near-dedup"](spark, docs, folder)
    component = groups({i: row[1] for i, row in rows.items()})
    assert {tuple(r) for r in single.collect()} == {row for i, row in rows.items() if component[i] == i}
    order = [r["doc_id"] for r in stages["mixing sources to target weights"](spark, docs, folder).collect()]
    assert order == _mixture(spark, docs, rows)
    packed_rows = stages["best-fit packing"](spark, docs, folder).collect()
    ids = {}
    for r in sorted(packed_rows, key=lambda r: r["piece"]):
        ids.setdefault(r["doc_id"], []).extend(r["ids"])
    assert ids == {i: [*WORD.encode(row[1] or "", add_special_tokens=False).ids, 0] for i, row in rows.items()}


def _scored(spark, docs, folder):
    from rangeload.llm.common import id_remainder
    from rangeload.llm.quality import score_quality

    network = fit_quality(docs.where(id_remainder("doc_id", 3) != 1), spark.read.parquet(f"{folder}/labels.parquet"))
    return score_quality(docs, network).collect()


def _mixture(spark, docs, rows):
    """Ids in the order of the schedule: rows of a source by the md5 of their id, blocks of 65,536 bytes."""
    import hashlib

    from pyspark.sql import functions as F

    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    parts = tempered_parts(docs, "source", size, 1000)
    first, cycle = {(s, k): slot for s, k, slot in cycle_slots(parts)}, sum(parts.values())
    placed = []
    for source in parts:
        start = 0
        for key, i in sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, row in rows.items() if row[3] == source):
            block, many = start // 65_536, parts[source]
            placed.append((block // many * cycle + first[source, block % many], start, key, i))
            start += len((rows[i][1] or "").encode()) + 1
    return [i for *_, i in sorted(placed)]
