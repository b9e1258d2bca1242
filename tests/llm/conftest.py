import os
import re

import pytest

from fieldbook.llm.common import SCHEMAS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """``docs([(1, "text"), ...])`` with further columns, some of them named like the operators' own."""

    def make(rows):
        full = [(*row, *(None,) * (5 - len(row)), "x", 7, 1.5, "y", "z", 8, True, 9, "l") for row in rows]
        schema = SCHEMAS["documents"] + (
            ", labels string, row long, score double, text_key string, own_key string, kept_id long, repeated boolean, spans int, label string"
        )
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def table(spark):
    """A table of the smallest size."""
    return lambda name: spark.read.schema(SCHEMAS[name]).parquet(os.path.join(SMALL, f"{name}.parquet"))


ODD = [
    (1, None), (2, ""), (None, "no id here, but some words to look at"), (3, "x"), (3, "x"), (4, "42 17"),
    (5, "word " * 30_000), (6, "ab" * 50_000), (7, "\x00\x1c  é 日本語 😀\n\n\t  end"), (None, None),
    (8, "x"), (8, "another text of the same id"),
]


def ascii_words(text):
    return [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]


def shingles(text, size=5):
    words = ascii_words(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0
