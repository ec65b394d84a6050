"""Tables that are replaced in one step.

A table's folder holds a folder of data for every version and, in ``_commits``, an empty file for every
version that is whole. The name of such a file is its record: a number and the name of the data folder. A
version counts from the moment its record is there, which every file system makes in one step, and the record
with the greatest number is the table. A job that fails leaves the version before it as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
DATA = "data"
DIGITS = 12


class Version(NamedTuple):
    number: int
    folder: str

    @property
    def record(self) -> str:
        return f"{self.number:0{DIGITS}d}-{self.folder}"


def _system(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system takes it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _names(spark: SparkSession, path: str) -> list[str]:
    system, location = _system(spark, path)
    if not system.exists(location):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(location))


def remove(spark: SparkSession, path: str) -> None:
    system, location = _system(spark, path)
    system.delete(location, True)


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The committed versions of a table, the current one last; none where there is no such table."""
    names = _names(spark, f"{path.rstrip('/')}/{COMMITS}")
    return [Version(int(name[:DIGITS]), name[DIGITS + 1 :]) for name in names]


def data_path(path: str, version: Version) -> str:
    return f"{path.rstrip('/')}/{DATA}/{version.folder}"


def current(spark: SparkSession, path: str) -> str | None:
    """The folder with the data of the current version."""
    known = versions(spark, path)
    return data_path(path, known[-1]) if known else None


def replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None], *, keep: int = 0) -> str:
    """Write a new version by ``write(df, folder)``, make it the table, and return its folder.

    Until ``write`` is through, readers get the version before; what it wrote is removed when it fails.
    Versions before the new one are removed after it, but for the last ``keep``, which jobs that are
    still reading may need. Of two jobs that write at once the later to finish wins, and neither touches the
    other's files before these are a version.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    target = data_path(path, Version(0, folder))
    try:
        write(df, target)
    except BaseException:
        remove(spark, target)
        raise
    before = versions(spark, path)
    new = Version(before[-1].number + 1 if before else 1, folder)
    system, record = _system(spark, f"{path.rstrip('/')}/{COMMITS}/{new.record}")
    system.create(record, False).close()
    remove_old(spark, path, keep=keep)
    return target


def remove_old(spark: SparkSession, path: str, *, keep: int = 0) -> None:
    """Remove the versions before the current one, but for the last ``keep`` of them."""
    known = versions(spark, path)
    for version in known[: max(0, len(known) - 1 - keep)]:
        remove(spark, data_path(path, version))
        remove(spark, f"{path.rstrip('/')}/{COMMITS}/{version.record}")


def remove_abandoned(spark: SparkSession, path: str) -> list[str]:
    """Remove data that no record names, as a job leaves whose driver was lost; only while nobody writes."""
    known = {version.folder for version in versions(spark, path)}
    left = [name for name in _names(spark, f"{path.rstrip('/')}/{DATA}") if name not in known]
    for name in left:
        remove(spark, f"{path.rstrip('/')}/{DATA}/{name}")
    return left
