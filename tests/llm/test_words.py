import random
import string

import public_tokenizers
import pyarrow as pa

from rangeload.llm import words

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_plain_words_go_straight_to_the_model(monkeypatch):
    """Each new word of letters used to pass two patterns first."""
    table = words.WordTable(PATH, words.packed, {}, 1000, lower=True)
    rng = random.Random(3)
    plain = ["".join(rng.choices(string.ascii_letters, k=rng.randint(1, 14))) for _ in range(500)]
    expected = [words.packed(table.ids(word)) for word in plain]
    monkeypatch.setattr(words, "_SIMPLE", None)
    monkeypatch.setattr(words, "_PARTS", None)
    assert [table[word] for word in plain] == expected


def test_ids_of_texts_are_the_library_s():
    rng = random.Random(4)
    letters = string.ascii_letters + string.digits + "äßéÿ'.,-İǅ中²"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["", None]
    table = words.WordTable(PATH, words.packed, {}, 500, lower=True)
    found = [list(memoryview(data).cast("I")) for data in words.each_text(table, pa.array(texts))]
    assert found == [table.ids(text or "") for text in texts]
