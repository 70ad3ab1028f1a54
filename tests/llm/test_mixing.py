import hashlib
import random
from collections import Counter

import pytest
from fixtures import documents
from pyspark.sql import functions as F

from rangeload.llm.mixing import cycle_slots, in_mixed_order, mix_sources, tempered_parts


@pytest.mark.parametrize("seed", range(10))
def test_less_than_one_block_from_the_weights(seed):
    rng = random.Random(seed)
    parts = {f"s{i}": rng.choice([1, 1, 2, 5, 40, 200]) for i in range(rng.randint(1, 12))}
    slots = cycle_slots(parts)
    cycle = sum(parts.values())
    assert [slot for _, _, slot in slots] == list(range(cycle))
    done = Counter()
    for t, (source, block, slot) in enumerate(slots, 1):
        assert block == done[source]
        assert block * cycle // parts[source] <= slot < -(-(block + 1) * cycle // parts[source])
        done[source] += 1
        assert all(abs(done[s] - t * parts[s] / cycle) < 1 for s in parts)
    assert done == Counter(parts)


def test_rows_follow_the_schedule(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 30), "en", rng.choice(["a", "a", "a", "b", "c", None]), 0) for i in range(500)]
    parts = {"a": 5, "b": 3, None: 1}  # c has no weight
    docs = documents(spark, rows, clash="slot")
    size = F.length("text") + 1
    for piece_rows in (20, 10_000):
        mixed = mix_sources(docs, parts, size=size, block_size=40, piece_rows=piece_rows)
        assert mixed.columns.count("slot") == 1
        found = mixed.collect()
        assert len(found) == 500
        first = {(s, k): slot for s, k, slot in cycle_slots(parts)}
        for source in ("a", "b", "c", None):
            start = 0
            own = sorted((r for r in found if r["source"] == source), key=lambda r: r["start"])
            keys = [hashlib.md5(str(r["doc_id"]).encode()).hexdigest() for r in own]
            assert keys == sorted(keys) == [r["mix_key"] for r in own]
            for r in own:
                assert r["start"] == start and r["block"] == start // 40
                start += len(r["text"]) + 1
                many = parts.get(source)
                assert r["slot"] == (None if many is None else r["block"] // many * 9 + first[source, r["block"] % many])
    ordered = in_mixed_order(mix_sources(docs, parts, size=size, block_size=40))
    expected = sorted(found, key=lambda r: (r["slot"] is None, r["slot"] or 0, r["start"], r["mix_key"]))
    assert [r["doc_id"] for r in ordered.collect()] == [r["doc_id"] for r in expected]
    assert "start" not in ordered.columns


def test_odd_rows(spark):
    docs = documents(spark)
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    parts = tempered_parts(docs, "source", size, 50)
    assert set(parts) == {"s1", "s2", "s3", None} and min(parts.values()) >= 1
    mixed = mix_sources(docs, parts, size=size).collect()
    assert len(mixed) == 12 and all(r["slot"] is not None for r in mixed)
    empty = documents(spark, [])
    assert tempered_parts(empty, "source", size, 50) == {}
    assert mix_sources(empty, {"s1": 1}).collect() == [] and mix_sources(empty, {}).collect() == []
    none = mix_sources(docs, {}).collect()
    assert len(none) == 12 and {r["slot"] for r in none} == {None}


def test_a_large_source_is_spread(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "'only' as source").withColumn("text", F.lit("x"))
    mixed = mix_sources(rows, {"only": 1}, block_size=10, piece_rows=100)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sorted(r["start"] for r in mixed.collect()) == list(range(4000))


def test_many_sources_keep_their_weights(spark):
    rows = spark.range(40_000).selectExpr("id as doc_id", "concat('s', if(id < 20000, 0, id % 1000)) as source").withColumn("text", F.lit("x"))
    parts = tempered_parts(rows, "source", F.lit(1), 1000)
    roots = {r["source"]: r["n"] ** 0.5 // 1 for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert sum(parts.values()) <= 1 << 20
    for source in ("s0", "s1"):
        target = roots[source] / sum(roots.values())
        assert abs(parts[source] / sum(parts.values()) - target) < 0.03 * target


def test_many_rows_without_a_key_are_spread(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "'only' as source", "string(id) as text")
    mixed = mix_sources(rows, {"only": 1}, block_size=10, piece_rows=100).collect()
    assert sorted(r["start"] for r in mixed) == list(range(3000))
    assert len({r["mix_key"] for r in mixed}) == 3000
