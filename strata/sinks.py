"""Writers. Each replaces its target, so running a job twice leaves one copy.

Layer tables and merged tables are replaced in one step (``strata.versions``): readers get the old table until
the new one is whole, and a job that fails leaves the old one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.files import manifest
from strata.sources.tables import read_parquet
from strata.versions import replace


def layer_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset.strip('/')}"


def write_layer(
    df: DataFrame, root: str, dataset: str, *, partition_by: Sequence[str] = (), keep: int = 0
) -> str:
    """Write a layer table as Parquet, replacing what is there; returns the folder with its files.

    ``keep`` earlier versions stay for jobs that still read them.
    """

    def write(df: DataFrame, folder: str) -> None:
        df.write.partitionBy(*partition_by).parquet(folder)

    return replace(df, layer_path(root, dataset), write, keep=keep)


def read_layer(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The current version of a layer table."""
    return read_parquet(spark, layer_path(root, dataset))


def publish(df: DataFrame, root: str, dataset: str, **options) -> DataFrame:
    """Write a layer table and list the files it consists of."""
    path = write_layer(df, root, dataset, **options)
    return manifest(df.sparkSession, path, dataset, pattern="*.parquet")


def write_merged(df: DataFrame, path: str) -> str:
    """Write Parquet in files of the size that adaptive execution aims at: a small table in one.

    Partitions are merged or split by their measured bytes, in the one run that writes them. Returns the
    folder with the files.
    """
    return replace(df, path, lambda df, folder: df.hint("rebalance").write.parquet(folder))


def replace_table(df: DataFrame, name: str, *, saved: bool = False) -> DataFrame:
    """Create or replace a named table: a view on the query, or a saved copy of its rows."""
    if saved:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """Write the one-row metrics document as JSON; NULL entries are written out.

    More than one row is an error.
    """
    rows = F.count(F.lit(1))
    several = F.raise_error(F.lit("the metrics document has more than one row")).cast("boolean")
    single = metrics.agg(
        *[F.first(name).alias(name) for name in metrics.columns],
        F.when(rows > 1, several).otherwise(True).alias("_single"),
    )
    single.where("_single").drop("_single").write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
