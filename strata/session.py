"""Session settings the library relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC decides the month a timestamp falls in; the rebase modes keep dates before 1582 unchanged;
# adaptive execution sizes shuffles, picks broadcast sides by their measured size and splits
# skewed join partitions. Master, memory and parallelism stay with whoever submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session that somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def create_session(app_name: str, **settings: str) -> SparkSession:
    """Get or create a session; in the names of ``settings`` two underscores stand for a dot."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir`` that every executor can reach.

    The cluster names that folder. Only a local master may go without one and gets a temporary
    folder, because there driver and executors share a disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _local_folder(spark)
    path = f"{root.rstrip('/')}/strata/{label}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Remove at the end what was written into the shared folder meanwhile.

    For a job that runs a query and stores its result elsewhere: within the scope the result can be computed, behind
    it the tables it was computed from are gone.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)
        for path in made:
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written into the shared folder and read back, so that it is worked out once."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _local_folder(spark: SparkSession) -> str:
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    return tempfile.mkdtemp(prefix="strata-")
