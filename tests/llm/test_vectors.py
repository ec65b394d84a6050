"""Hard negatives, held to brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import hard_negatives


@given(st.integers(1, 150), st.integers(1, 2**22), st.integers(0, 10))
@settings(max_examples=40, deadline=None)
def test_products_are_exact(dim, most, seed):
    drawn = np.random.default_rng(seed)
    one, other = drawn.integers(-most, most + 1, (4, dim)), drawn.integers(-most, most + 1, (5, dim))
    one[0], other[0], other[1] = most, most, -most
    primes = hard_negatives.moduli(dim * most**2)
    sides = [hard_negatives.residues(side, primes) for side in (one, other)]
    assert (hard_negatives.products(*sides, primes) == one.astype(object) @ other.T.astype(object)).all()


def mined(rows, step, positives=5, negatives=10, low=30, high=90, scale=256):
    """``(anchor, positive, rank, negative, scores)`` by comparing every anchor with every row."""
    known = set()
    for vec_id, label, vector in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            known.add((vec_id, label, tuple(math.floor(scale * x) for x in vector)))
    order = lambda found: sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))
    result = []
    for anchor in known:
        if anchor[0] is None or anchor[0] % step:
            continue
        scored = [(sum(a * b for a, b in zip(anchor[2], row[2])), row[0], row[1]) for row in known if row != anchor]
        for score, positive, _ in order(f for f in scored if f[2] == anchor[1])[:positives]:
            near = order(f for f in scored if f[2] != anchor[1] and low * score <= 100 * f[0] <= high * score)
            for rank, (other, negative, _) in enumerate(near[:negatives], 1):
                result.append((anchor[0], positive, rank, negative, score, other))
    return sorted(result, key=str)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>, row string, id string, anchor string, vector string")


def with_clashes(rows):
    return [(*row, "x", "y", "z", "v") for row in rows]


def test_awkward_vectors(vectors):
    drawn = random.Random(5)
    rows = [(i, drawn.randint(0, 3), [float(np.float32(drawn.gauss(0, 0.3))) for _ in range(8)]) for i in range(150)]
    rows += [(i, 1, rows[3][2]) for i in range(200, 240)]  # ties
    rows += rows[:20]  # rows given twice
    rows += [(10, 2, rows[7][2]), (None, 1, rows[1][2]), (None, 2, rows[1][2])]  # an id of two rows, and none
    rows += [(300, None, rows[0][2]), (310, 1, None), (320, 1, [None, 1.0]), (330, 1, [math.nan] * 8), (340, 2, [math.inf] * 8)]
    rows += [(350, 1, []), (360, 1, [0.5, -0.5, 0.25]), (370, 3, [0.0] * 8)]
    df = vectors(with_clashes(rows)).repartition(5)
    condition = F.col("vec_id") % 10 == 0
    expected = mined(rows, 10)
    assert len(expected) > 300
    assert rows_of(hard_negatives.mine(df, condition)) == expected
    # in several passes, and with few rows of a kind
    assert rows_of(hard_negatives.mine(df, condition, batch=40)) == expected
    few = dict(positives=2, negatives=3, low=-50, high=100)
    assert rows_of(hard_negatives.mine(df, condition, **few)) == mined(rows, 10, **few)


def test_crowded_windows(vectors, monkeypatch):
    """Many rows within reach at once, so that only the best of a part are looked at."""
    monkeypatch.setattr(hard_negatives, "CROWD", 1)
    drawn = random.Random(6)
    rows = [(i, i % 2, [drawn.choice([0.5, 0.75]) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, 0, [0.75] * 6) for i in range(200)]  # a vector that a third of all rows share
    got = hard_negatives.mine(vectors(with_clashes(rows)).repartition(3), F.col("vec_id") % 50 == 0)
    assert rows_of(got) == mined(rows, 50)


def test_no_vectors(vectors):
    assert hard_negatives.mine(vectors([]), F.lit(True)).count() == 0
    assert hard_negatives.mine(vectors(with_clashes([(1, 1, [1.0])])), F.lit(False)).count() == 0
    assert hard_negatives.mine(vectors(with_clashes([(1, 1, [1.0])])), F.lit(True)).count() == 0
    with pytest.raises(ValueError, match="too large"):
        hard_negatives.mine(vectors(with_clashes([(1, 1, [1e30])])), F.lit(True))
