"""Reshaping, selection, aggregation, slots, quality and storage on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import aggregate, quality, reshape, select, slots, storage

QUICK = hypothesis_settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Reshaping


def test_sheet_to_rows(spark):
    sheet = spark.createDataFrame(
        [("2000", "1.5", "x"), ("1799", "1", "2"), ("2101", "1", "2"), ("total", "1", "2"), ("1800", None, "3"), ("2100.0", "nan", "4")],
        ["Budget Year", "Fossil (Gt)", "Land\nuse"],
    )
    assert rows(reshape.sheet_to_rows(sheet)) == [
        (1800, "land_use", 3.0),
        (2000, "fossil_gt", 1.5),
        (2100, "land_use", 4.0),
    ]


def test_names_equal_after_normalising_fail(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "A-B"])
    with pytest.raises(ValueError, match="a_b"):
        reshape.snake_case_columns(df)


def test_year_column():
    assert reshape.year_column(["x", "the_year", "year"]) == "the_year"
    assert reshape.year_column(["x", "y"]) == "x"


def test_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "a")], "a int, `b.c` string, d string")
    assert reshape.drop_empty_columns(df).columns == ["a", "d"]


def test_months_round_trip(spark):
    names = reshape.MONTH_NAMES
    wide = spark.createDataFrame(
        [("1990", *[str(i / 10) for i in range(12)]), ("1991", *["***"] * 12), ("bad", *["1"] * 12)],
        ["Year", *names],
    )
    long = reshape.months_to_rows(wide)
    assert long.count() == 36
    got = {(r["year"], r["month"]): r for r in long.collect()}
    assert got[1990, "12"]["anomaly"] == 1.1 and got[1990, "12"]["date"] == dt.date(1990, 12, 1)
    assert got[1991, "01"]["anomaly"] is None
    assert got[None, "01"]["date"] is None
    back = long.where("year = 1990").groupBy("year").pivot("month").agg(F.first("anomaly"))
    assert [back.first()[f"{i:02d}"] for i in range(1, 13)] == [i / 10 for i in range(12)]


# Selection


def test_box_edges(spark):
    df = spark.createDataFrame(
        [(-11.0, 90.0), (28.0, 142.0), (-11.1, 100.0), (0.0, 142.1), (None, 100.0)], "lat double, lon double"
    )
    assert select.in_box(df, select.Box()).count() == 2


@QUICK
@given(
    st.lists(st.one_of(st.none(), st.text("abtmT2 ", max_size=4)), max_size=8),
    st.lists(st.sampled_from(["t2m", "a", "b", "tm"]), max_size=3),
)
def test_choose_match_against_a_plain_model(spark, names, preferences):
    usable = sorted(n for n in names if n)
    expected = usable[0] if usable else None
    for preference in reversed(preferences):
        expected = next((n for n in usable if preference in n.lower()), expected)
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert select.choose_match(df, "n", preferences).first()["target"] == expected


def test_missing_target_fails(spark):
    empty = spark.createDataFrame([], "n string")
    target = select.required_target(select.choose_match(empty, "n", ["a"]), "nothing to choose")
    with pytest.raises(Exception, match="nothing to choose"):
        spark.range(1).select(target).collect()


def test_guard(spark):
    with pytest.raises(ValueError, match="no rows"):
        select.require_rows(spark.range(0), "no rows")


def test_first_rows_and_last_duplicate(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "f", 0, 0), ("b", 2.0, "f", 0, 1), ("a", 3.0, "f", 100, 0), ("c", 4.0, "g", 0, 0)],
        "station_id string, lat double, file_path string, block_start long, row_id long",
    )
    first = select.first_rows(df, 3)
    assert rows(select.last_row_per_key(first, "station_id").select("station_id", "lat")) == [("a", 3.0), ("b", 2.0)]


def test_places_and_many_first_rows(spark, monkeypatch, settings):
    """Ties, NULLs, several partitions and a column with the name of a helper; no task gets over its share."""
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    settings(spark__sql__files__maxPartitionBytes="1000", spark__sql__files__openCostInBytes="1000")
    values = [None if i % 50 == 0 else i % 7 for i in range(4000)]
    df = spark.createDataFrame([(v, i, "x") for i, v in enumerate(values)], "k int, i int, `a.b` string").repartition(13)
    placed = select.with_place(df, ["k", "i"])
    expected = sorted(range(4000), key=lambda i: (values[i] is not None, values[i] or 0, i))
    assert [r["i"] for r in sorted(placed.collect(), key=lambda r: r["place"])] == expected
    assert {r["place"] for r in select.with_place(df, ["k"]).collect()} == set(range(1, 4001))
    assert select.with_place(df.where("i < 0"), ["i"]).isEmpty()
    monkeypatch.setattr(select, "FEW_ROWS", 10)
    half = select.first_rows(df, 2000, ["k", "i"])
    assert sorted(r["i"] for r in half.collect()) == sorted(expected[:2000]) and half.columns == df.columns
    tasks = half.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 1000
    assert select.first_rows(df, 9000, ["i"]).count() == 4000


def test_small_side_is_broadcast_only_within_the_bound(spark, monkeypatch):
    facts, names = spark.range(10), spark.range(5).withColumnRenamed("id", "k")

    def plan(side):
        return select.attach(facts, side, "id", "k")._jdf.queryExecution().toString()

    assert "strategy=broadcast" in plan(select.small_side(names))
    assert select.measured_bytes(names) == 5 * select.VALUE_BYTES
    wide = names.select(F.repeat(F.lit("é"), 100).alias("a.b"), "k")
    assert select.measured_bytes(wide) == 5 * (200 + 2 * select.VALUE_BYTES)
    monkeypatch.setattr(select, "MAX_BROADCAST_BYTES", 4)
    assert "strategy=broadcast" not in plan(select.small_side(names))


def test_hot_key_is_split_when_the_lookup_side_is_too_large(spark, settings, monkeypatch):
    monkeypatch.setattr(select, "MAX_BROADCAST_BYTES", 0)
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    facts = spark.range(0, 200_000, 1, 16).select(key.alias("k"), "id", F.uuid().alias("pad"))
    names = spark.range(1000).select(F.col("id").alias("key"), F.uuid().alias("name"))
    joined = select.attach(facts, select.small_side(names), "k", "key")
    assert joined.count() == 200_000
    materialised = joined.select(F.sum(F.length("pad") + F.length("name")))
    materialised.collect()
    assert "skew=true" in materialised._jdf.queryExecution().executedPlan().toString()


# Aggregation


def test_grid_mean_ignores_nan(spark):
    nan = float("nan")
    cells = spark.createDataFrame(
        [("t2m", None, 1.0), ("t2m", None, nan), ("t2m", None, 3.0), ("tp", "m", nan), ("lat", "d", 1.0)],
        "variable string, units string, value double",
    )
    means = aggregate.grid_mean(aggregate.data_variables(cells), ["variable", "units"])
    assert rows(means) == [("t2m", None, 2.0), ("tp", "m", None)]


def test_grid_mean_of_several_arrays_per_key(spark):
    arrays = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [6.0]), ("b", [])], "k string, c array<double>")
    assert rows(aggregate.grid_mean_of_arrays(arrays, ["k"], "c")) == [("a", 3.0)]


def test_stable_order_keeps_read_order_of_equal_keys(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 2).alias("k"), "id")
    got = [(r["k"], r["id"]) for r in aggregate.in_stable_order(df, "k").collect()]
    assert got == sorted(got)


# Slots


def line(station="AA000000001", year="2001", month="01", element="TMAX", slots=()):
    return f"{station}{year}{month}{element}" + "".join(slots)


def decode(spark, *texts, **options):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return slots.decode_daily_lines(df, **options)


def test_slots_that_count(spark):
    texts = [
        line(slots=["  123   ", "-9999   ", "  -50T S", "   10 X ", "        ", "  7"]),
        line(month="02", element="PRCP", slots=["        "] * 27 + ["    1   ", "    2   ", "    3   "]),
        line(element="SNOW", slots=["   10   "]),
        line(month="13", slots=["   10   "]),
        line(year="0000", slots=["   10   "]),
        "AA0000000012001",
        line(year=" 999", month=" 1", slots=["  x     ", "\t      ", "   20   "]),
    ]
    got = rows(decode(spark, *texts).select("date", "element", "value", "mflag", "qflag", "sflag"))
    assert got == [
        (dt.date(2001, 1, 1), "TMAX", 12.3, None, None, None),
        (dt.date(2001, 1, 3), "TMAX", -5.0, "T", None, "S"),
        (dt.date(2001, 1, 6), "TMAX", 0.7, None, None, None),
        (dt.date(2001, 2, 28), "PRCP", 0.1, None, None, None),
        (dt.date(999, 1, 3), "TMAX", 2.0, None, None, None),
    ]
    counts = slots.count_slots(spark.createDataFrame([(t,) for t in texts], "value string")).first()
    assert counts["lines"] == 7 and counts["short_lines"] == 1 and counts["other_lines"] == 1
    assert counts["kept_slots"] == 5 and counts["flagged_slots"] == 1 and counts["missing_slots"] == 1
    assert counts["impossible_day_slots"] == 2 and counts["malformed_slots"] == 1
    assert counts["bad_month_slots"] == 62
    assert sum(counts[f"{o}_slots"] for o in slots.OUTCOMES) == 5 * 31


def test_strict_decoding_fails_on_malformed_numbers(spark):
    for text in (line(slots=["  x     "]), line(year="20x1", slots=["    1   "])):
        with pytest.raises(Exception, match="malformed"):
            decode(spark, text, strict=True).collect()
    assert decode(spark, line(slots=["\t    ", "    1   "]), strict=True).count() == 1


@QUICK
@given(
    st.dictionaries(
        st.dates(dt.date(1, 1, 1), dt.date(9999, 12, 31)),
        st.integers(-9998, 99999),
        max_size=30,
    )
)
def test_daily_round_trip(spark, observed):
    months = {}
    for date, value in observed.items():
        months.setdefault((date.year, date.month), {})[date.day] = value
    texts = [
        line(
            year=f"{year:04d}",
            month=f"{month:02d}",
            slots=[f"{days[d]:5d}   " if d in days else " " * 8 for d in range(1, 32)],
        )
        for (year, month), days in months.items()
    ]
    got = decode(spark, *texts).collect()
    assert {r["date"]: r["value"] for r in got} == {d: v / 10.0 for d, v in observed.items()}


# Quality and storage


def test_quality_of_an_empty_table_is_zero(spark):
    empty = spark.createDataFrame([], "anomaly double")
    assert tuple(quality.range_quality(empty, "anomaly").first()) == (0.0, 0.0)


def test_wide_and_range_quality(spark):
    wide = spark.createDataFrame([("1", "x"), (None, "6")], "a string, b string")
    assert tuple(quality.wide_quality(wide, ["a", "b"]).first()) == (0.75, 0.25)
    long = spark.createDataFrame([(-5.0,), (5.0,), (5.1,), (None,)], "v double")
    assert tuple(quality.range_quality(long, "v").first()) == (0.75, 0.5)


def test_scores_and_overall(spark):
    scores = spark.createDataFrame(
        [("a", "raw", 0.0), ("b", "raw", 1.0), ("a", "silver", 1.0), ("b", "silver", 1.0)],
        "dataset string, layer string, score double",
    )
    table = quality.score_table(quality.with_overall(scores))
    assert rows(table) == [("a", 0.0, 1.0), ("b", 1.0, 1.0), ("overall", 0.5, 1.0)]


def test_reconciliation(spark):
    def listing(*files):
        return spark.createDataFrame(files, "relative_path string, length long")

    files = storage.reconcile(listing(("a", 1), ("b", 2), ("c", 3)), listing(("b", 2), ("c", 4), ("d", 5)))
    assert {r["relative_path"]: r["status"] for r in files.collect()} == {
        "a": "only_local",
        "b": "same",
        "c": "size_differs",
        "d": "only_stored",
    }
    assert tuple(storage.reconciliation_counts(files).first()) == (3, 3, 3, True)


def test_compression_of_empty_layers(spark):
    files = spark.createDataFrame([("bronze", 10)], "layer string, length long")
    assert tuple(storage.layer_sizes(files).first()) == (10, 0, 0)
    assert tuple(storage.compression(storage.layer_sizes(files)).first()) == (None, None)


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "inner"])
def test_rows_of_a_hot_key_are_spread(spark, settings, monkeypatch, how):
    """A third of the rows under one key: no task of 200 gets over three times the median."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="200")
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    n = 120_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 9_973).cast("string"))
    facts = spark.range(n, numPartitions=16).withColumn("key", key)
    named = spark.range(9_973).select(F.col("id").cast("string").alias("key"), (F.col("id") % 2).alias("odd"))
    keys = named.unionByName(spark.createDataFrame([("hot", 0)], "key string, odd bigint"))
    if how != "inner":
        keys = (keys if how == "left_semi" else spark.createDataFrame([("none",)], "key string")).select("key")
    plain = facts.join(keys, "key", how)
    monkeypatch.setattr(select, "MAX_BROADCAST_BYTES", 0)
    spread = select.join_spread(facts, keys, "key", how)
    assert spread.columns == plain.columns
    per_task = spread.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.sum("id").alias("ids")).collect()
    tasks = sorted(row["n"] for row in per_task)
    assert (sum(tasks), sum(row["ids"] for row in per_task)) == (n, n * (n - 1) // 2)  # every row has its key or none has
    assert len(tasks) >= 195 and tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_rows_without_a_key_are_spread(spark, settings, monkeypatch):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="200")
    monkeypatch.setattr(select, "MAX_BROADCAST_BYTES", 0)
    facts = spark.range(30_000).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id")))
    known = spark.range(0, 30_000, 2).withColumnRenamed("id", "key")
    missing = select.keep_missing(facts, known, "key")
    per_task = missing.groupBy(F.spark_partition_id()).agg(
        F.count("id").alias("n"), F.count("key").alias("keys"), F.count_if(F.col("key") % 2 == 0).alias("wrong")
    ).collect()
    tasks = sorted(row["n"] for row in per_task)
    assert (sum(tasks), sum(row["keys"] for row in per_task), sum(row["wrong"] for row in per_task)) == (20_000, 10_000, 0)
    assert tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_spread_joins_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(select, "MAX_BROADCAST_BYTES", 0)
    facts = spark.range(90).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id")))
    known = spark.range(0, 90, 2).withColumnRenamed("id", "key")
    assert sorted(row["key"] for row in select.keep_known(facts, known, "key").collect()) == [k for k in range(0, 90, 2) if k % 3]
    assert select.keep_known(facts.where("id < 0"), known, "key").count() == 0
    assert select.keep_missing(facts, known.where("false"), "key").count() == 90


def test_heavy_keys_are_few(spark):
    facts = spark.range(10_000).withColumn("key", F.when(F.col("id") < 6_000, 0).otherwise(F.col("id") % 500))
    heavy = {row["key"]: row["_salts"] for row in select.heavy_keys(facts, "key", 20).collect()}
    assert heavy == {0: 193}
    assert select.heavy_keys(facts, "key", 2_000).count() < 2_000 and select.heavy_keys(facts.where("false"), "key").count() == 0


def test_a_slot_is_read_once(spark):
    """The text of a slot is cut, and its number read, in one place of the plan, not once for each use."""
    plan = decode(spark, line(slots=["  123   "]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
    assert [r["value"] for r in decode(spark, line(slots=["\t  12   ", " \t      ", "   1    "])).collect()] == [1.2, 0.1]
