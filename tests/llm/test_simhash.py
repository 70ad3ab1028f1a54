import random

import xxhash
from fixtures import documents, words

from rangeload.llm import simhash as operator
from rangeload.llm.components import _least_neighbour, connected_components
from rangeload.llm.simhash import fingerprint_links, near_duplicates, simhash

SPACE = " \t\n\x0b\f\r"


def plain_print(text):
    found = [w for w in "".join(" " if c in SPACE else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The least node reachable from each, by comparing all with all."""
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and found[a] != found[b]:
                    found[a] = found[b] = min(found[a], found[b])
                    changed = True
    return found


def test_fingerprint():
    rng = random.Random(1)
    texts = ["", None, " \n", "One", "one TWO", "One two three", "É É É É", "a b c\x1cd e", words(rng, 400), "x y z " * 40_000]
    for text in texts:
        assert simhash(text) == plain_print(text)


def links_of(spark, prints, crowd):
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").repartition(3)
    found = connected_components(fingerprint_links(df, crowd))
    made = {p: p for p in prints}
    roots = {r["node"] % (1 << 64): r["component"] for r in found.collect()}
    for p in prints:
        made[p] = roots.get(p, p - (1 << 64) if p >> 63 else p)
    return made


def test_links_join_what_is_within_two_bits(spark):
    rng = random.Random(7)
    for crowd in (2, 8):
        prints = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
        for base in list(prints)[:12]:
            for _ in range(rng.randint(1, 20)):
                near = base
                for bit in rng.sample(range(64), rng.randint(1, 4)):
                    near ^= 1 << bit
                prints.add(near)
                base = rng.choice([base, near])
        prints = sorted(prints)
        found = links_of(spark, prints, crowd)
        expected = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
        assert {frozenset(p for p in prints if found[p] == c) for c in found.values()} == {
            frozenset(p for p in prints if expected[p] == c) for c in expected.values()
        }


def test_documents(spark):
    rng = random.Random(5)
    base = [words(rng, 60) for _ in range(6)]
    near = [text.replace(" ", "  ").upper() for text in base] + [text + " tail" for text in base]
    rows = [(100 - i, text, "en", "s", 0) for i, text in enumerate(base + near)]
    docs = documents(spark, rows + [(5, "a b", "en", "s", 0), (5, "a b", "en", "s", 0), (6, None, "en", "s", 0), (7, " ", "en", "s", 0), (None, "a b", "en", "s", 0)], clash="fp")
    found = sorted((r["doc_id"] or -1, r["fp"], r["component"]) for r in near_duplicates(docs).collect())
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = {i: plain_print(t) for i, t in texts if i is not None}
    expected = groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    wanted = [(i, signed(prints[i]), expected[i]) for i, _ in texts if i is not None] + [(-1, signed(plain_print("a b")), 5)]
    assert found == sorted(wanted)
    assert near_duplicates(documents(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rest = [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)]
    rows = [*chain, *star, *rest, *chain[:5], (None, 3), (7, 7), (-4, -9)]
    rng.shuffle(rows)
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    pairs = {(a, b) for a, b in rows if a is not None and a != b}
    nodes = {x for pair in pairs for x in pair}
    expected = {n: n for n in nodes}
    for _ in nodes:
        for a, b in pairs:
            expected[a] = expected[b] = min(expected[a], expected[b])
    assert found == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_few_shuffles_in_a_round(spark):
    """A round of both steps used to take eight shuffles; each leaves files and tasks for every partition, however few the links."""
    links = spark.range(100).selectExpr("id as a", "id + 1 as b").localCheckpoint()
    plan = _least_neighbour(_least_neighbour(links, upward=True), upward=False)._jdf.queryExecution().sparkPlan().toString()
    both = _least_neighbour(links, upward=True)._jdf.queryExecution().sparkPlan().toString()
    assert "Union" not in plan and both.count("HashAggregate") == 2  # partial and final of the minimum, no distinct


def shuffled_rows(df):
    """Rows that the exchanges of ``df`` write, which is run for it."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        rows = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        return rows + sum(visit(node.children().apply(i)) for i in range(node.children().size()))

    return visit(execution.executedPlan())


def test_variants_are_not_shuffled(spark, monkeypatch):
    """All 64 variants of each fingerprint used to be shuffled, to count them and again to find who shares one."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    near = {base} | {base ^ (1 << bit) for bit in range(0, 64, 8)}
    prints = near | {rng.getrandbits(64) for _ in range(2_000)}
    settled = []

    def settle(df):
        settled.append(df)
        return df.localCheckpoint()

    monkeypatch.setattr(operator, "settle", settle)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").localCheckpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = fingerprint_links(df)
        assert links.count() >= len(near) - 1
        counted, found = shuffled_rows(settled[0]), shuffled_rows(links.where("a <> b"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert 0 < counted <= 9 * len(prints) and 0 < found <= 24 * len(prints)
