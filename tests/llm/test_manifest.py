"""Merkle manifests against trees built the plain way."""

import hashlib
import random
import zlib

import pytest
from fixtures import documents

from rangeload.llm import manifest, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(leaves):
    """All levels of a tree, from the leaves to the one node at the top."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def siblings_of(levels, nth):
    found = []
    for level in levels[:-1]:
        run = level[nth // 16 * 16 : nth // 16 * 16 + 16]
        found += run[: nth % 16] + run[nth % 16 + 1 :]
        nth //= 16
    return found


def postorder(levels):
    """(level, index) of all nodes, children before their parent."""

    def below(level, index):
        if level:
            for child in range(index * 16, min(index * 16 + 16, len(levels[level - 1]))):
                yield from below(level - 1, child)
        yield level, index

    return list(below(len(levels) - 1, 0))


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4097, 5000])
def test_positions(leaves):
    levels = levels_of([sha(str(i)) for i in range(leaves)])
    order = postorder(levels)
    assert [manifest.position(level, index, leaves) for level, index in order] == list(range(len(order)))
    assert manifest.height(leaves) == len(levels) - 1
    if leaves <= manifest.BLOCK:
        builder = manifest.Builder()
        for leaf in levels[0]:
            builder.append(leaf)
        assert builder.close(manifest.height(leaves)) == levels[-1][0]
        assert builder.nodes == [levels[level][index] for level, index in order]


def plain(rows):
    """What build_manifest has to give for (part, key, digest) rows: by row its subroot, siblings and place, and the root."""
    parts = {}
    for part, key, digest in rows:
        parts.setdefault(part, []).append((key is not None, key, digest))
    trees = {part: levels_of([d for *_, d in sorted(found)]) for part, found in parts.items()}
    order = sorted(parts, key=lambda part: (part is not None, (part or "").encode()))
    top = levels_of([trees[part][-1][0] for part in order])
    found = []
    for at, part in enumerate(order):
        places = {node: n for n, node in enumerate(postorder(trees[part]))}
        above = siblings_of(top, at)
        for nth, digest in enumerate(trees[part][0]):
            found.append((part or "-", digest, places[0, nth], trees[part][-1][0], "".join(siblings_of(trees[part], nth) + above)))
    return sorted(found), top[-1][0]


def check(spark, rows):
    df = spark.createDataFrame(rows, "name string, key long, digest string").repartition(3)
    built = manifest.build_manifest(df, part="name", order=["key"])
    found, root = plain(rows)
    assert built.root == root
    proofs = built.proofs().collect()
    assert sorted((r["name"] or "-", r["digest"], r["position"], r["subroot"], "".join(r["proof"])) for r in proofs) == found
    assert all(r["folded"] == root for r in proofs)
    return built


def test_a_part_of_several_blocks(spark):
    rows = [("big", i, sha(f"b{i}")) for i in range(4100)] + [("small", i, sha(f"s{i}")) for i in range(3)] + [(None, 7, sha("n"))]
    rows += [("exact", i, sha(f"e{i}")) for i in range(256)]
    random.Random(1).shuffle(rows)
    built = check(spark, rows)
    log = {(r["part"], r["position"]): r["digest"] for r in built.log().where("part = '=big'").collect()}
    levels = levels_of([sha(f"b{i}") for i in range(4100)])
    kept = {("=big", n): levels[level][index] for n, (level, index) in enumerate(postorder(levels)) if level <= 3}
    assert log == kept


def test_more_parts_than_a_block(spark):
    check(spark, [(f"p{i}", i, sha(str(i))) for i in range(4200)])


def test_odd_rows(spark):
    rows = [("", None, sha("a")), ("", None, sha("b")), ("", None, sha("a")), (None, 1, sha("c")), ("é", 2, sha("d")), ("z", 2, sha("e")), ("z", 2, sha("e"))]
    check(spark, rows)
    check(spark, rows[:1])


def test_a_changed_leaf_folds_to_another_root(spark):
    rows = [("p", i, sha(str(i)), sha("other") if i % 3 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "part string, nth long, leaf string, position string")
    built = manifest.build_manifest(df, part="part", order=["nth"], leaf="leaf")
    for row in built.proofs("position").collect():
        assert (row["folded"] == built.root) == (row["nth"] % 3 != 0)
        assert row["part"] == "p"


def test_an_empty_table(spark):
    built = manifest.build_manifest(spark.createDataFrame([], "name string, key long, digest string"), part="name", order=["key"])
    assert built.root is None and built.proofs().collect() == [] and built.log().collect() == []


@pytest.mark.parametrize("clash", ["digest", "nth", "leaf"])
def test_query_on_odd_rows(spark, folder, clash):
    documents(spark, clash=clash).write.parquet(f"{folder}/documents.parquet")
    rows = queries.op12_postorder_manifest(spark, folder).collect()
    assert len(rows) == 12 and len({r["root"] for r in rows}) == 1
    again = {r["doc_id"]: r for r in rows}
    for doc in documents(spark).collect():
        values = [doc[name] for name in ("doc_id", "source", "lang", "n_chars", "text")]
        text = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
        row = again[doc["doc_id"]]
        assert row["leaf"] == sha(text)
        tampered = doc["doc_id"] is not None and zlib.crc32(str(doc["doc_id"]).encode()) % 5 == 0
        changed = tampered and doc["text"] is not None and doc["text"].encode().lower() != doc["text"].encode()
        assert row["verified"] == (not changed) == (row["folded_root"] == row["root"])


def test_query_on_an_empty_table(spark, folder):
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    assert queries.op12_postorder_manifest(spark, folder).collect() == []
