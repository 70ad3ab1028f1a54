"""Small tables for the corpus operators."""

from __future__ import annotations

import random
import string

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: Cases every operator on documents has to take: nulls, empty, short, very long, repeated, odd characters.
ODD = [
    (None, "a text without an id that goes on for a while", "en", "s1", 5),
    (1, None, "en", "s1", None),
    (2, "", None, None, 0),
    (3, "   \n\t \n", "en", "s1", 7),
    (4, "word", "en", "s2", 4),
    (5, "same text in two rows", "en", "s2", 21),
    (6, "same text in two rows", "en", "s2", 21),
    (7, "a repeated row of the table", "en", "s2", 27),
    (7, "a repeated row of the table", "en", "s2", 27),
    (8, "long " * 60_000, "en", "s3", 300_000),
    (9, "ÀÉÎ ñandú straße <|endoftext|> x  y\x1cz 'tis 12345 \U0001f600", "de", "s3", 40),
    (10, "!!! ??? ...", "fr", None, 11),
]


def words(rng: random.Random, many: int) -> str:
    return " ".join("".join(rng.choices(string.ascii_lowercase[:8], k=rng.randint(1, 7))) for _ in range(many))


def documents(spark, rows=None, clash: str | None = None, parts: int = 3):
    """A table of documents, with one more column named ``clash`` if given."""
    df = spark.createDataFrame(ODD if rows is None else rows, DOCUMENTS).repartition(parts)
    if clash:
        df = df.selectExpr("*", f"'other' as {clash}")
    return df
