"""Votes of the nearest neighbours: against brute force, on held-out rows, and on awkward ones."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AWKWARD, SF_DIR
from strata.llm import quality_classifier as qc
from strata.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def voters(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    return qc.fit(docs, labels, F.col("quality"))


def terms(text):
    """Shares of a text's terms, word by word."""
    factor, mask = 0x9E3779B97F4A7C15, 2**64 - 1

    def bucket(hashed, salt):
        mixed = (hashed + salt) * factor & mask
        mixed ^= mixed >> 29
        return (mixed * factor & mask) >> 52

    def hashed(values):
        return sum(value * pow(factor, i + 1, 2**64) for i, value in enumerate(values)) & mask

    words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    found = Counter()
    for i, word in enumerate(words):
        kinds = []
        for byte in word:
            lower, upper = 97 <= byte <= 122 or byte >= 128, 65 <= byte <= 90
            kinds.append(1 if lower else 2 if upper else 3 if 48 <= byte <= 57 else byte + 4)
        shape = [kind for k, kind in enumerate(kinds) if not k or kinds[k - 1] != kind][:12]
        letters = [(byte + 32 if kind == 2 else byte) + 1 for byte, kind in zip(word, kinds) if kind in (1, 2)]
        found[bucket(hashed(shape), 1)] += 1 / len(words)
        if letters:
            found[bucket(hashed(letters), 2)] += 1 / len(words)
        if i and word == words[i - 1]:
            found[bucket(0, 3)] += 1 / len(words)
    found[bucket(len(words).bit_length(), 4)] += 1
    return found


def voted(voters, text):
    """The score of one text, term by term and voter by voter."""
    vector = np.zeros(voters.axes.shape[1])
    for bucket, share in terms(text).items():
        vector += share**0.5 * voters.rareness[bucket] * voters.axes[bucket].astype(float)
    length = float(np.linalg.norm(vector))
    near = [(float(v.astype(float) @ vector) / length if length else 0.0, label) for v, label in zip(voters.vectors, voters.labels)]
    near = sorted(near, reverse=True)
    near = [n for n in near if n[0] >= near[min(qc.NEIGHBOURS, len(near)) - 1][0] - 1e-6]
    weights = [max(cosine, 0) ** qc.SHARPNESS for cosine, _ in near]
    return sum(w * label for w, (_, label) in zip(weights, near)) / sum(weights) if sum(weights) > 1e-9 else voters.otherwise


def test_scores_equal_brute_force(spark, texts, voters):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {row["doc_id"]: row["score"] for row in qc.score(docs, voters).collect()}
    assert got == {doc: pytest.approx(voted(voters, text or ""), abs=0.02) for doc, text in texts.items()}


def test_axes_are_singular_vectors():
    """Subspace iteration finds the space of the leading singular vectors."""
    drawn = np.random.default_rng(1)
    matrix = drawn.standard_normal((60, 5)) @ drawn.standard_normal((5, 40))
    axes = np.linalg.qr(drawn.standard_normal((40, 5)))[0]
    for _ in range(qc.ROUNDS):
        axes = np.linalg.qr(matrix.T @ (matrix @ axes))[0]
    best = np.linalg.svd(matrix, full_matrices=False)[2][:5]
    assert np.allclose(np.abs(np.linalg.svd(best @ axes)[1]), 1)


def test_held_out_rows(spark):
    rows = queries.QUERIES["op13_quality_classifier"](spark, SF)
    assert rows.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    known = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == 1000
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.7) for row in rows)
    judged = [(row["predicted"], known[row["doc_id"]]) for row in rows if row["held_out"] and row["doc_id"] in known]
    assert sum(p == q for p, q in judged) >= 0.9 * len(judged)
    assert sum(p for p, q in judged if q) >= 0.97 * sum(q for _, q in judged)


def test_awkward_rows(spark, awkward, no_rows, voters):
    got = qc.score(awkward, voters).collect()
    assert len(got) == len(AWKWARD) and all(0 <= row["score"] <= 1 for row in got)
    by_text = {}
    for row, (doc, text) in zip(got, AWKWARD):
        assert row["doc_id"] == doc
        by_text.setdefault(text or "", set()).add(round(row["score"], 6))
    assert all(len(scores) == 1 for scores in by_text.values())  # labels and ids play no part in a score
    assert qc.score(no_rows, voters).count() == 0


def test_fit_on_awkward_rows(spark, awkward, no_rows):
    schema = "doc_id bigint, good int, _id string, label string, text string"
    labels = [(1, 1), (2, 0), (3, None), (None, 1), (5, 1), (5, 0), (6, 1), (8, 1), (12, 0), (999, 0)]
    labels = spark.createDataFrame([(*row, "x", "y", "z") for row in labels], schema)
    voters = qc.fit(awkward, labels, F.col("good"), dimensions=4)
    # 1, 2, 5 with two labels, 6 given twice, 8 and 12
    assert (len(voters.labels), voters.labels.sum()) == (8, 5)
    scores = {row["doc_id"]: row["score"] for row in qc.score(awkward, voters).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    for docs, known in ((no_rows, labels), (awkward, labels.where("false")), (no_rows, labels.where("false"))):
        none = qc.fit(docs, known, F.col("good"))
        assert {row["score"] for row in qc.score(awkward, none).collect()} == {0.5}


def test_bounded_number_of_voters(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    voters = qc.fit(docs, labels, F.col("quality"), max_labelled=100)
    assert 50 < len(voters.labels) < 150


@given(st.lists(st.text(st.sampled_from("abAB é1.!$\n\t"), max_size=40), max_size=6), st.sampled_from([3, 8, 10**6]))
@settings(max_examples=150, deadline=None)
def test_terms(drawn, piece):
    drawn = [text if piece > 100 else re.sub(r"\S{2,}", "a", text) for text in drawn]  # no word is longer than a piece
    before, qc.PIECE = qc.PIECE, piece
    try:
        got = qc.terms_of(pa.array(["x", *drawn, "y"]).slice(1, len(drawn)))
    finally:
        qc.PIECE = before
    assert got.shape == (len(drawn), qc.BUCKETS)
    for row, text in zip(got, drawn):
        assert {bucket: pytest.approx(share) for bucket, share in terms(text).items()} == {i: row[i] for i in np.flatnonzero(row)}


def test_shapes():
    one, other, third = qc.terms_of(pa.array(["WORD!!", "OTHER!", "Word,"]))
    assert len(set(np.flatnonzero(one)) & set(np.flatnonzero(other))) == 2  # shape and length
    assert len(set(np.flatnonzero(one)) & set(np.flatnonzero(third))) == 2  # letters and length
