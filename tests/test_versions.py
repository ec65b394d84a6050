"""Tables replaced in one step."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata import versions
from strata.sinks import publish, read_layer, write_layer, write_merged
from strata.sources.tables import read_parquet


def numbers(spark, n):
    return spark.range(n, numPartitions=4).withColumnRenamed("id", "k")


def failing(spark, n, at):
    bad = F.when(F.col("k") == at, F.raise_error(F.lit("no more"))).otherwise(F.col("k"))
    return numbers(spark, n).withColumn("k", bad)


@pytest.mark.parametrize("write", ["layer", "merged"])
def test_a_failing_job_leaves_the_old_rows(spark, tmp_path, write):
    root, path = str(tmp_path), str(tmp_path / "a" / "b")
    store = (lambda df: write_layer(df, root, "a/b")) if write == "layer" else (lambda df: write_merged(df, path))
    with pytest.raises(Exception, match="no more"):
        store(failing(spark, 100, 99))
    assert versions.current(spark, path) is None and versions.remove_abandoned(spark, path) == []
    store(numbers(spark, 10))
    old = read_layer(spark, root, "a/b")
    with pytest.raises(Exception, match="no more"):
        store(failing(spark, 100, 99))
    assert old.count() == 10 and read_layer(spark, root, "a/b").count() == 10
    store(numbers(spark, 20))
    assert read_layer(spark, root, "a/b").count() == 20
    assert len(os.listdir(f"{path}/data")) == 1
    assert [v.number for v in versions.versions(spark, path)] == [2]


def test_readers_get_the_old_table_until_the_new_one_is_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(numbers(spark, 5), path, lambda df, folder: df.write.parquet(folder))
    seen = []

    def write(df, folder):
        df.write.parquet(folder)
        seen.append(read_parquet(spark, path).count())

    versions.replace(numbers(spark, 7), path, write)
    assert seen == [5] and read_parquet(spark, path).count() == 7


def test_two_jobs_at_once(spark, tmp_path):
    """The one that finishes later wins, also where both saw the same versions."""
    path = str(tmp_path / "t")
    inner = []

    def slow(df, folder):
        df.write.parquet(folder)
        inner.append(versions.replace(numbers(spark, 3), path, lambda df, folder: df.write.parquet(folder)))

    versions.replace(numbers(spark, 8), path, slow)
    assert read_parquet(spark, path).count() == 8
    assert [v.number for v in versions.versions(spark, path)] == [2] and not os.path.exists(inner[0])


def test_earlier_versions_can_be_kept(spark, tmp_path):
    root = str(tmp_path)
    for n in range(1, 6):
        write_layer(numbers(spark, n), root, "t", keep=2)
    assert [v.number for v in versions.versions(spark, f"{root}/t")] == [3, 4, 5]
    sizes = [spark.read.parquet(versions.data_path(f"{root}/t", v)).count() for v in versions.versions(spark, f"{root}/t")]
    assert sizes == [3, 4, 5] and read_layer(spark, root, "t").count() == 5


def test_data_without_a_record_is_no_version(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "t")
    write_layer(numbers(spark, 4), root, "t")
    numbers(spark, 9).write.parquet(f"{path}/data/left-by-a-lost-driver")
    assert read_layer(spark, root, "t").count() == 4
    assert versions.remove_abandoned(spark, path) == ["left-by-a-lost-driver"]
    assert read_layer(spark, root, "t").count() == 4 and len(os.listdir(f"{path}/data")) == 1


def test_folders_without_versions_are_read_as_they_are(spark, tmp_path):
    plain = str(tmp_path / "plain")
    numbers(spark, 6).write.parquet(plain)
    write_layer(numbers(spark, 2), str(tmp_path), "t")
    assert read_parquet(spark, plain, str(tmp_path / "t")).count() == 8
    assert read_parquet(spark, str(tmp_path / "pl*")).count() == 6


def test_partitions_and_listing(spark, tmp_path):
    parts = numbers(spark, 10).withColumn("p", F.col("k") % 2)
    for _ in range(2):
        files = publish(parts, str(tmp_path), "parts", partition_by=["p"])
    assert read_layer(spark, str(tmp_path), "parts").where("p = 1").count() == 5
    assert files.where("relative_path like 'p=_/%'").count() == files.count() > 0
