"""Small tables with awkward rows, and the brute-force answers the operators are held to."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF_DIR = "/root/testdata/sf0.001"
# Names that the operators use themselves, as further columns of the input.
CLASHING = "words lines kept cleaned id doc place head whole text_hash start shard slot rank size drawn item_id region a b"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in CLASHING.split()
)


def sentence(seed: int, words: int) -> str:
    """Distinct made-up words, the same ones for the same seed."""
    return " ".join(f"w{seed}x{i}" for i in range(words)) + "."


LONG = sentence(1, 30_000)
BASE = sentence(2, 120)
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\r "),
    (4, "one"),
    (5, BASE),
    (6, BASE),
    (6, BASE),
    (7, BASE.replace("w2x60", "other")),
    (8, LONG),
    (9, LONG[:120_000] + " and more"),
    (None, "no id " + sentence(3, 40)),
    (None, None),
    (10, "the same line here\n" * 30),
    (11, "Größe ŉ İstanbul 日本語 \x1f <|endoftext|> \U0001f600 " + sentence(4, 30)),
    (12, "a" * 5_000),
    (13, sentence(2, 60) + "\n" + sentence(5, 60)),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [
        (doc, text, None, None if i % 5 == 0 else f"s{i % 3}", None, *["x"] * len(CLASHING.split()))
        for i, (doc, text) in enumerate(AWKWARD)
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {row["doc_id"]: row["text"] for row in docs.select("doc_id", "text").collect()}
