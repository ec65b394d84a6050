"""The shared folder comes from the session; only a local master may go without it."""

from __future__ import annotations

import os

import pytest

from strata.session import SETTINGS, intermediates, shared_folder, stored


class Session:
    """Stands in for a session, of which only the settings are read."""

    def __init__(self, **settings):
        self.settings = {key.replace("__", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_folder_named_by_the_cluster():
    session = Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    first, second = shared_folder(session, "a"), shared_folder(session, "a")
    assert first.startswith("hdfs:///shared/strata/a-") and first != second


def test_cluster_without_a_folder_fails():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark__master="yarn"), "a")


def test_local_master_gets_a_folder():
    assert "strata-" in shared_folder(Session(spark__master="local[2]"), "a")


def test_settings_are_applied(spark):
    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())


def test_intermediates_are_removed(spark, tmp_path):
    with intermediates(spark) as made:
        rows = stored(spark.range(5), "numbers")
        assert rows.count() == 5 and len(made) == 1
        rows.write.parquet(str(tmp_path / "result"))
    assert not os.path.exists(made[0].removeprefix("file:"))
    assert spark.read.parquet(str(tmp_path / "result")).count() == 5
    kept = stored(spark.range(3), "numbers")
    with pytest.raises(ZeroDivisionError), intermediates(spark) as made:
        stored(spark.range(1), "numbers")
        raise ZeroDivisionError
    assert not os.path.exists(made[0].removeprefix("file:")) and kept.count() == 3
