"""Sums that do not depend on the order of addition."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strata.operators.exact import exact_mean, exact_sums


def bits(value):
    return None if value is None else struct.pack("<d", value)


def nearest(values):
    """The double nearest to the sum, by fractions."""
    total = sum(map(Fraction, values), Fraction(0))
    return total.numerator / total.denominator


def cases():
    drawn = random.Random(9)
    found = {
        "tenths": [0.1] * 10,
        "cancelling": [1e300, 1.0, -1e300],
        "ties": [2.0**53, 1.0, 2.0**-40],
        "tie_to_even": [2.0**53, 1.0],
        "negative": [-0.1, -0.2, -1e-20, 3e-17],
        "zeros": [0.0, -0.0, 0.0],
        "powers": [2.0**k for k in range(-300, 300, 7)] + [-(2.0**k) for k in range(-299, 300, 11)],
        "edges": [2.0 ** (24 * k) for k in range(-30, 30)] + [math.nextafter(2.0 ** (24 * k), 0) for k in range(-30, 30)],
        "tiny": [5e-324, 5e-324, 2.0**-1022, 1e-310],
        "large": [1.7e308, -1.6e308, 1e292],
        "whole": [float(i) for i in range(1000)],
        "nothing": [1e16, 1.0, -1e16, -1.0],
        "one": [0.3],
    }
    for k in range(25):
        found[f"drawn{k}"] = [drawn.uniform(-1, 1) * 10.0 ** drawn.randint(-15, 15) for _ in range(drawn.randint(1, 60))]
    return found


def test_sums_are_the_nearest_doubles(spark):
    rows = [(name, value) for name, values in cases().items() for value in values]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "name string, x double").repartition(7)
    got = {row["name"]: (row["_sum"], row["_n"]) for row in exact_sums(df, ["name"], "x").collect()}
    for name, values in cases().items():
        assert got[name][1] == len(values)
        assert got[name][0] == nearest(values), name


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_means_have_the_same_bits(spark, settings, parts):
    settings(spark__sql__shuffle__partitions=str(parts))
    rows = [(i % 5 if i % 11 else None, math.sin(i) * 10.0 ** (i % 9)) for i in range(4_000)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(parts, F.hash("x"))
    got = {row["k"]: row["x"] for row in exact_mean(df, ["k"], "x").collect()}
    for key in (None, 0, 1, 2, 3, 4):
        values = [x for k, x in rows if k == key]
        assert bits(got[key]) == bits(nearest(values) / len(values))


def test_nulls_nan_and_infinities(spark):
    rows = [("a", None), ("b", None), ("b", 2.0), ("c", math.nan), ("c", 1.0), ("d", math.inf), ("d", 5.0), ("e", math.inf), ("e", -math.inf)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {row["k"]: row["mean"] for row in exact_mean(df, [F.col("k")], "x", "mean").collect()}
    assert got["a"] is None and got["b"] == 2.0 and math.isnan(got["c"]) and got["d"] == math.inf and math.isnan(got["e"])
    assert exact_mean(df.where("false"), ["k"], "x").count() == 0
    assert exact_mean(df.where("k = 'b'").withColumn("x", F.lit(3)), ["k"], "x").first()["x"] == 3.0
