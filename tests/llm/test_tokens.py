import random

import public_tokenizers
from fixtures import documents, words
from tokenizers import Tokenizer

from rangeload.llm.tokens import count_tokens, pre_tokens, token_counts
from rangeload.llm.words import BYTE_CHARACTERS, WordTable

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_are_the_librarys(spark):
    tokenizer = Tokenizer.from_file(PATH)
    docs = documents(spark, clash="key")
    found = sorted((row["doc_id"] or 0, row["n_bytes"], row["n_tokens"]) for row in token_counts(docs, PATH).collect())
    texts = [(row["doc_id"] or 0, row["text"] or "") for row in docs.collect()]
    assert found == sorted((i, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in texts)


def test_small_table_and_cache():
    rng = random.Random(4)
    tokenizer = Tokenizer.from_file(PATH)
    lengths = WordTable(PATH, len, {" a": 1}, most=5)
    spaces = ["a  b", "a \n b", " \n\n a", "a\n \nb  ", "x   y", "don't we'll", "é à.\tÑ", "a\x1c b", "1 22 333", "<|endoftext|><|endoftext|> a", "\n  x", "ÿ.,"]
    texts = spaces + ["".join(rng.choices(" \n\tab.,'sé1　", k=30)) for _ in range(300)] + [words(rng, 50)]
    for text in texts:
        assert "".join(pre_tokens(text)) == text
        assert count_tokens(lengths, text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert len(lengths) <= 6


def test_byte_characters():
    from tokenizers.pre_tokenizers import ByteLevel

    assert sorted(BYTE_CHARACTERS) == sorted(ByteLevel.alphabet())


def test_empty_table(spark):
    assert token_counts(documents(spark, []), PATH).collect() == []
