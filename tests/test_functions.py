"""Null, sentinel, number, date and text rules."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.functions import dates, text, values


def evaluate(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_numbers_from_text(spark):
    raw = ["1", " -.18\t", "+2.", "1e3", "***", "", None, "NaN", "nan", "1d", "2.5F", "0x1p3", "1_0", "abc", "1 2"]
    expected = [1.0, -0.18, 2.0, 1000.0] + [None] * 11
    assert evaluate(spark, raw, values.number("x")) == expected


def test_infinite_numbers_are_numbers(spark):
    assert evaluate(spark, ["inf", "-Infinity"], values.number("x")) == [math.inf, -math.inf]


def test_whole_numbers_from_text(spark):
    raw = [" 12", "-3 ", "+4", "1.5", "", None, "x", "99999999999"]
    assert evaluate(spark, raw, values.whole_number("x")) == [12, -3, 4] + [None] * 5


def test_sentinels_and_nan(spark):
    assert evaluate(spark, ["***", " *** ", ".1"], values.without_sentinel("x", "***")) == [None, None, ".1"]
    assert evaluate(spark, [1.0, float("nan"), None], values.nan_to_null("x"), "double") == [1.0, None, None]


def test_ratio_and_share_of_nothing(spark):
    zero, one = F.lit(0), F.lit(1)
    row = spark.range(1).select(
        values.share(one, zero).alias("share"), values.ratio(one, zero).alias("ratio")
    ).first()
    assert row["share"] == 0.0 and row["ratio"] is None


def test_required_fails_only_when_malformed(spark):
    df = spark.createDataFrame([("a",), ("",)], "x string")
    good = df.where("x <> ''").select(values.required(F.col("x"), F.col("x") == "", "blank"))
    assert [r[0] for r in good.collect()] == ["a"]
    with pytest.raises(Exception, match="blank"):
        df.select(values.required(F.col("x"), F.col("x") == "", "blank")).collect()


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("  Fossil fuel\nand industry ", "fossil_fuel_and_industry"),
        ("__a--b__", "a_b"),
        ("Été 1", "t_1"),
        ("%%", "col"),
        ("", "col"),
    ],
)
def test_snake_case(spark, raw, expected):
    assert evaluate(spark, [raw], text.snake_case("x")) == [expected]
    assert text.snake_name(raw) == expected


def test_human_sizes_match_plain_rounding(spark):
    def plain(size):
        for unit in ("B", "KB", "MB", "GB", "TB"):
            if size < 1024:
                return f"{size:.1f}{unit}"
            size /= 1024
        return f"{size:.1f}PB"

    rng = random.Random(7)
    sizes = [0, 1, 1023, 1024, 1280, 1792, 33040962033, 2918731, 24311, 2**53]
    sizes += [rng.randrange(2 ** rng.randrange(1, 56)) for _ in range(2000)]
    assert evaluate(spark, sizes, text.human_size("x"), "long") == [plain(s) for s in sizes]


def test_number_formats(spark):
    raw = [11320.317642496002, 0.03125, 0.5, None]
    assert evaluate(spark, raw, text.ratio_text("x"), "double") == ["11320.32x", "0.03x", "0.50x", "n/a"]
    assert evaluate(spark, raw, text.four_decimals("x"), "double") == ["11320.3176", "0.0312", "0.5000", "n/a"]


def test_number_formats_at_decimal_ties(spark):
    """Python's own formatting rounds the stored binary value."""
    raw = [2.675, 0.12345, 0.00005, 1.005, 0.125, 0.375, -2.5, -0.00001, 1e15 / 3, 4.5e15, 1e13 / 7, 0.0, 2.0**52 / 100]
    raw += [random.Random(1).randrange(10**7) / 10**k for k in range(1, 7) for _ in range(50)]
    drawn = random.Random(2)
    raw += [drawn.randrange(10**6) / 1000 + 0.0005 for _ in range(500)] + [drawn.random() * 10**drawn.randint(-6, 11) for _ in range(500)]
    for digits in (1, 2, 4):
        assert evaluate(spark, raw, text.exact_decimals("x", digits), "double") == [f"{x:.{digits}f}" for x in raw]


def test_paths(spark):
    raw = ["a/b/c.tar.gz", "s3a://x/USC1.dly", "plain", "a/.hidden", "a/b.", "dir/"]
    assert evaluate(spark, raw, text.base_name("x")) == ["c.tar.gz", "USC1.dly", "plain", ".hidden", "b.", ""]
    assert evaluate(spark, raw, text.file_stem("x")) == ["c.tar", "USC1", "plain", ".hidden", "b.", ""]


def test_dates_from_parts(spark):
    df = spark.createDataFrame(
        [("2000", "2", "29"), ("2001", "02", "29"), (" 999", " 1", "1"), ("x", "1", "1"), (None, "1", "1"), ("2000", "13", "1")],
        "y string, m string, d string",
    )
    got = [r[0] for r in df.select(dates.date_from_parts("y", "m", F.col("d"))).collect()]
    assert got == [dt.date(2000, 2, 29), None, dt.date(999, 1, 1), None, None, None]


def test_month_names(spark):
    assert evaluate(spark, ["Jan", "Dec", "jan", None], dates.month_number("x")) == [1, 12, None, None]


def test_times(spark):
    raw = ["2024-03-05 06:07:08.9", "noon", None]
    assert evaluate(spark, raw, dates.second_text(dates.text_to_timestamp("x"))) == ["2024-03-05 06:07:08", None, None]
    assert evaluate(spark, raw, dates.month_bucket(dates.text_to_timestamp("x"))) == [dt.date(2024, 3, 1), None, None]
    assert evaluate(spark, ["2024-02-30", " 2024-02-29"], dates.text_to_date("x")) == [None, dt.date(2024, 2, 29)]


def test_strip_takes_blanks_and_other_white_space_alike(spark):
    texts = [" \t a b\u00a0 \n ", "\t \t", "   ", "", "\r x", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(text.strip("t").alias("s")).collect()
    assert [r["s"] for r in got] == ["a b\u00a0", "", "", "", "x", None]
