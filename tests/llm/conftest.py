"""Documents with everything that may go wrong, shared by all tests of the operators."""

import random

import pytest
from pyspark.sql import types as T

SYLLABLES = "an be ci dor el fa gun hil io ja ke lum mor ni os pra qui ra sen tu".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    out = []
    for i in range(words):
        word = "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))
        out.append(word.capitalize() + "." if i % 12 == 11 else word)
    return " ".join(out)


# Columns whose names the operators use themselves.
CLASHES = ["n_tokens", "key", "block", "size", "shard", "kept", "spans", "window", "item_id", "part"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)


def frame(spark, rows):
    """Rows of ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` as documents."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, "en", "src0")[:4] if len(row) == 2 else row
        full.append((doc_id, text, lang, source, len(text or ""), *["x"] * len(CLASHES)))
    return spark.createDataFrame(full, SCHEMA)


ODD_ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, prose(4, 80)),
    (4, prose(4, 80)),  # the row again
    (5, prose(4, 80)),  # its text again
    (None, prose(6, 60)),
    (None, None),
    (7, "x" * 50_000),
    (8, "é日本😀 \x85" * 40),
    (9, prose(9, 20_000)),
    (10, prose(10, 70), None, None),
    (11, "a\x00b <|endoftext|> c  d\r\n\te"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD_ROWS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.fixture
def scratch(spark):
    from citeloom.scratch import Scratch

    kept = Scratch(spark, "test")
    yield kept
    kept.close()
