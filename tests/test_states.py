"""Quality counts kept per file."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import presence_counts, range_counts, range_quality
from strata.operators.states import known_states, refresh_states, shares_of_states
from strata.plans.evaluation import quality_scores, refreshed_scores


def counts(df):
    return range_counts("v", 0.0, 5.0)


def write(spark, values, path, mode="append", files=2):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    rows.repartition(files).write.mode(mode).parquet(path)


def test_only_new_and_changed_files_are_counted(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "states")
    write(spark, [1.0, None, 9.0, 4.0], path)
    first = refresh_states(spark, path, root, "t", counts)
    assert {r["run"] for r in first.collect()} == {1}
    before = {r["path"] for r in first.collect()}
    write(spark, [2.0, None, None], path, files=1)
    second = refresh_states(spark, path, root, "t", counts)
    rows = second.collect()
    assert {r["path"] for r in rows if r["run"] == 1} == before and sum(r["run"] == 2 for r in rows) == 1
    full = range_quality(spark.read.parquet(path), "v", 0.0, 5.0).first()
    assert shares_of_states(second).first() == full
    assert {r["run"] for r in refresh_states(spark, path, root, "t", counts).collect()} == {1, 2}
    write(spark, [7.0], path, mode="overwrite", files=1)
    third = refresh_states(spark, path, root, "t", counts)
    assert {r["run"] for r in third.where("cells > 0").collect()} == {3}
    assert tuple(shares_of_states(third).first()) == (1.0, 0.0)


def test_files_without_rows_are_counted_once(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "states")
    spark.createDataFrame([], "v double").write.parquet(path)
    states = refresh_states(spark, path, root, "t", counts)
    assert [r["cells"] for r in states.collect()] == [0] and tuple(shares_of_states(states).first()) == (0.0, 0.0)
    assert {r["run"] for r in refresh_states(spark, path, root, "t", counts).collect()} == {1}


def test_a_failed_run_leaves_the_counts(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "states")
    write(spark, [1.0], path, files=1)
    refresh_states(spark, path, root, "t", counts)
    write(spark, [2.0], path)
    failing = lambda df: presence_counts(F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception, match="stop"):
        refresh_states(spark, path, root, "t", failing).collect()
    assert [r["run"] for r in known_states(spark, root, "t").collect()] == [1]


def test_partitioned_folders(spark, tmp_path):
    path, root = str(tmp_path / "t"), str(tmp_path / "states")
    rows = spark.createDataFrame([(1, "a b"), (2, "é"), (3, None)], "v int, p string")
    rows.write.partitionBy("p").parquet(path)
    states = refresh_states(spark, path, root, "t", lambda df: presence_counts("p"))
    assert sum(r["complete"] for r in states.collect()) == 2 and sum(r["cells"] for r in states.collect()) == 3


def test_scores_of_all_tables(spark, tmp_path):
    tables = {
        "nasa": spark.createDataFrame([(1.0,), (9.0,), (None,)], "anomaly double"),
        "gcb": spark.createDataFrame([(1.0,), (None,)], "value double"),
        "era5": spark.createDataFrame([(1.0, "2000-01-01", "t"), (2.0, "x", "t")], "value double, time string, variable string"),
        "noaa": spark.createDataFrame([(1.0, "2000-01-01", "TMAX"), (2.0, "2000-01-01", "ZZ")], "value double, date string, element string"),
    }
    folders = {name: str(tmp_path / name) for name in tables}
    for name, df in tables.items():
        df.write.parquet(folders[name])
    wide = spark.createDataFrame([("1",) * 12], [m.capitalize() for m in "jan feb mar apr may jun jul aug sep oct nov dec".split()])
    expected = quality_scores(tables | {"nasa": wide}, tables).where("layer = 'silver' and dataset != 'overall'")
    got = refreshed_scores(spark, folders, str(tmp_path / "states"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in expected.collect()}
