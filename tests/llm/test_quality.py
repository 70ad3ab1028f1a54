import random

import numpy as np
import pytest
from fixtures import documents, words

from rangeload.llm.quality import BLOCK, CHUNK, HOP, STRIDE, WIDTH, ByteNetwork, fit_quality, keep_likely, padded, score_quality


def plain_chunks(network, text):
    """Scores of a text's chunks, filter by filter and place by place."""
    data = padded(text)
    places = range(0, len(data) - WIDTH + 1, STRIDE)
    acts = np.array([sum(network.tables[j, data[p + j]] for j in range(WIDTH)) for p in places])
    blocks = -(-len(acts) // BLOCK)
    per, hop = CHUNK // BLOCK, HOP // BLOCK
    starts = [0] if blocks <= per else sorted({*range(0, blocks - per, hop), blocks - per})
    scores = []
    for s in starts:
        part = acts[s * BLOCK : (s + per) * BLOCK]
        features = [*np.maximum(part.max(axis=0) + network.offset, 0), np.log(min(len(acts), CHUNK) / CHUNK)]
        scores.append(float(np.dot(features, network.weight) + network.bias[0]))
    return scores


@pytest.mark.parametrize("length", [0, 1, 7, 8, 9, 12, 13, 63, 64, 259, 260, 261, 300, 511, 1031, 9000])
def test_summary_covers_the_whole_text(length):
    network = ByteNetwork(4)
    draw = np.random.default_rng(length)
    network.weight[:] = draw.normal(size=5)
    text = bytes(draw.integers(1, 256, length, dtype=np.uint8))
    scores = plain_chunks(network, text)
    expected = [np.mean(scores), np.min(scores), np.quantile(scores, 0.2), np.log(len(scores))]
    assert np.allclose(network.summary(text, network.paired()), expected, atol=1e-4)


def labelled(spark, many, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(many):
        good = rng.random() < 0.6
        text = words(rng, rng.randint(5, 150))
        rows.append((i, text if good else text.replace(" ", "##! "), "en", "s", 0))
        labels.append((i, int(good), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark, 400, 1)
    network = fit_quality(docs, labels)
    other, truth = labelled(spark, 200, 2)
    found = {r["doc_id"]: r["score"] for r in score_quality(other, network).collect()}
    right = sum((found[r["doc_id"]] >= 0.5) == bool(r["quality"]) for r in truth.collect())
    assert right >= 192 and all(0 <= s <= 1 for s in found.values())
    again = fit_quality(docs.repartition(5), labels.repartition(2))
    assert np.array_equal(network.tables, again.tables) and np.array_equal(network.combination, again.combination)
    kept = {r["doc_id"] for r in keep_likely(other, network).collect()}
    assert kept == {i for i, s in found.items() if s >= 0.5}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (8, 0, 0), (8, 0, 1), (1, 1, 0), (2, None, None), (3, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    network = fit_quality(documents(spark, clash="label"), labels)
    scores = [(r["doc_id"], r["score"]) for r in score_quality(documents(spark, clash="score"), network).collect()]
    assert len(scores) == 12 and all(0 <= s <= 1 for _, s in scores)
    assert len({s for i, s in scores if i == 7}) == 1
    assert len({s for i, s in scores if i in (1, 2)}) == 1


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    network = fit_quality(documents(spark), none)
    assert {r["score"] for r in score_quality(documents(spark), network).collect()} == {0.5}
    assert score_quality(documents(spark, []), network).collect() == []
