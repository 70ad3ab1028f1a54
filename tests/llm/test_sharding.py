from collections import Counter

import numpy as np
import pytest
from fixtures import documents

from rangeload.llm.queries import op2_hypergeometric_shards
from rangeload.llm.sharding import matrix_row, shard_sizes, shuffle_into_shards


def test_matrix_is_exact():
    counts = np.array([7, 0, 30, 1, 12])
    sizes = shard_sizes(int(counts.sum()), 4)
    rows = [matrix_row(sizes, counts, part, seed=5) for part in range(len(counts))]
    assert [row.sum() for row in rows] == counts.tolist()
    assert np.sum(rows, axis=0).tolist() == sizes.tolist()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 4


def test_matrix_is_uniform():
    counts, sizes = np.array([6, 4]), np.array([5, 5])
    drawn = Counter(int(matrix_row(sizes, counts, 0, seed)[0]) for seed in range(4000))
    # of 10 rows, 5 go to the first cell: hypergeometric with 6 of the first partition
    expected = {1: 6 / 252, 2: 60 / 252, 3: 120 / 252, 4: 60 / 252, 5: 6 / 252}
    assert all(abs(drawn[n] / 4000 - share) < 0.03 for n, share in expected.items())


@pytest.mark.parametrize("cell_rows", [1, 2, 100])
def test_slots_have_no_gaps(spark, cell_rows):
    docs = documents(spark)
    rows = shuffle_into_shards(docs, 5, cell_rows=cell_rows).collect()
    assert Counter(row["text"] for row in rows) == Counter(row["text"] for row in docs.collect())
    shards = {s: sorted(row["slot"] for row in rows if row["shard"] == s) for s in range(5)}
    assert all(slots == list(range(len(slots))) for slots in shards.values())
    assert {len(slots) for slots in shards.values()} <= {2, 3}


def test_same_shards_again(spark, folder):
    documents(spark).write.parquet(f"{folder}/d")
    docs = spark.read.parquet(f"{folder}/d")
    one, two = (sorted(map(repr, shuffle_into_shards(docs, 3, settled=True, seed=s).collect())) for s in (1, 1))
    assert one == two
    assert one != sorted(map(repr, shuffle_into_shards(docs, 3, settled=True, seed=2).collect()))


def test_rows_move_alone(spark):
    # rows of one input partition do not stay together or in order
    rows = shuffle_into_shards(spark.range(0, 400, 1, 4), 4).collect()
    first = [row["id"] for row in sorted(rows, key=lambda r: (r["shard"], r["slot"]))][:100]
    assert first != sorted(first) and 10 < sum(i < 100 for i in first) < 45


def test_empty_and_clashing(spark):
    assert shuffle_into_shards(documents(spark, [])).collect() == []
    made = shuffle_into_shards(documents(spark, clash="slot"), 2)
    assert made.columns.count("slot") == 1 and made.schema["slot"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        shuffle_into_shards(documents(spark), 0)


def test_scan_cut_anew(spark, folder):
    # the result is planned again when the scan is cut into other partitions than it was counted in
    documents(spark, [(i, f"text {i}", "en", "s", 0) for i in range(600)], parts=12).write.parquet(f"{folder}/documents.parquet")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    try:
        for first, then in (("1g", "1k"), ("1k", "1g")):
            spark.conf.set(size, first)
            made = op2_hypergeometric_shards(spark, folder)
            spark.conf.set(size, then)
            rows = made.collect()
            assert sorted(r["doc_id"] for r in rows) == list(range(600))
            assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, n) for s in range(24) for n in range(25)]
    finally:
        spark.conf.set(size, before)
