from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

LONG = "one long sentence that is used again and again in many of the texts, with fifty bytes and more\n"
ODD = [
    (1, "Hello there, my friend\nshort\n  HELLO THERE, my friend\t\nlast line of one", "en", "a"),
    (2, "hello there, my friend\nshort\nanother line of text\n\n", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\r\x0b\x0c\n \n", "en", None),
    (6, "!!! 123 ### $$$\n*** |||", None, "b"),
    (7, "Übergröße straße über alles größer\nÜBERGRÖSSE", "de", "é"),
    (8, LONG * 3 + "eight", "en", "a"),
    (9, "nine " + LONG * 2 + LONG[:60], "en", "b"),
    (10, "word " * 5000 + "\n" + "x" * 70000, "en", "c"),
    (11, "y" + "x" * 300, "en", "c"),
    (2, "hello there, my friend\nshort\nanother line of text\n\n", "en", "a"),
    (12, "one two", "en", "a"),
    (13, "One\tTWO", "en", "z"),
    (None, "a text without an id that says hello there, my friend\nanother line of text", "en", "a"),
    (None, LONG + "tail", "fr", None),
    (14, "a <|endoftext|> b <|EndOfText|> \x01 c\x01d   e 'S 'll İ", "en", "a"),
    (15, "emoji \U0001f600 and á combined, ligature ﬁ", "en", "a"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, blanks, long texts, repeated rows, and columns whose names operators might use themselves."""
    names = "row id hash tag h pos key size source_size part bucket print root letters kept doc text_hash".split()
    fields = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([(*r, len(r[1] or ""), *["other"] * len(names)) for r in ODD], fields)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture
def pairs():
    """(doc_id, text) of a frame."""
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture
def bag():
    """Rows of a frame as a multiset."""
    from collections import Counter

    return lambda df: Counter(tuple(r) for r in df.collect())
