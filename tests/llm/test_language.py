import random

from fixtures import documents, words

from rangeload.llm.language import learn_dictionaries, predict_language

WORDS = {
    "en": "the and of to in is was that for with this from have not are they which one were her".split(),
    "de": "der und die zu den von ist das mit sich auf für nicht ein eine auch werden über schön größer".split(),
    "es": "que de la el en los del se por las con una para está también año más señor niño qué".split(),
}


def corpus(many, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randint(20, 80))), lang, "s", 0) for i in range(many) for lang in [rng.choice(list(WORDS))]]


def test_held_out_accuracy(spark):
    learned = learn_dictionaries(documents(spark, corpus(200, 1)))
    assert set(learned) == set(WORDS)
    test = corpus(200, 2)
    found = {r["doc_id"]: r for r in predict_language(documents(spark, test, clash="score"), learned).collect()}
    right = sum(found[i]["lang_pred"] == lang for i, _, lang, _, _ in test)
    assert right >= 195 and all(0 <= r["score"] <= 1 for r in found.values())
    sure = [found[i]["lang_pred"] == lang for i, _, lang, _, _ in test if found[i]["accepted"]]
    assert len(sure) > 150 and sum(sure) >= len(sure) - 1


def test_odd_rows(spark):
    learned = learn_dictionaries(documents(spark))
    found = [(r["doc_id"], r["lang_pred"], r["score"], r["accepted"]) for r in predict_language(documents(spark), learned).collect()]
    assert len(found) == 12
    assert {f for f in found if f[1] == "und"} == {(i, "und", 0.0, False) for i in (1, 2, 3, 10)}
    assert len({f[1:] for f in found if f[0] == 7}) == 1


def test_mixed_up_text_is_rejected(spark):
    learned = learn_dictionaries(documents(spark, corpus(200, 1)))
    rng = random.Random(3)
    rows = [(1, words(rng, 5), None, None, 0), (2, " ".join(WORDS["de"] * 3), None, None, 0)]
    found = {r["doc_id"]: r["accepted"] for r in predict_language(documents(spark, rows), learned, margin=0.1).collect()}
    assert found == {1: False, 2: True}


def test_nothing_learned(spark):
    empty = documents(spark, [])
    assert learn_dictionaries(empty) == {}
    assert predict_language(empty, {}).collect() == []
    assert {r["lang_pred"] for r in predict_language(documents(spark), {}).collect()} == {"und"}


def test_numerals_are_no_letters(spark):
    learned = learn_dictionaries(documents(spark, corpus(200, 1)))
    rows = [(1, "½ ²", None, None, 0), (2, "½ a", None, None, 0), (3, "①_ 12", None, None, 0), (4, "٣", None, None, 0), (5, "日", None, None, 0)]
    found = {r["doc_id"]: r["lang_pred"] for r in predict_language(documents(spark, rows), learned).collect()}
    assert [found[i] == "und" for i in range(1, 6)] == [True, False, True, True, False]
