"""Quality counts kept for every file of a table, so that only files not yet counted are read.

Counts of files add up to those of the table. A file is known by path, length and time; one that was changed
is counted again, and the counts of one that is gone go with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import plain_path
from strata.functions.values import share
from strata.operators.quality import Counts
from strata.session import stored
from strata.sinks import layer_path, read_layer, write_layer
from strata.sources.files import manifest
from strata.versions import current

FILE = ["path", "length", "modificationTime"]
STATES = "path string, length long, modificationTime timestamp, run long, complete long, valid long, cells long"


def known_states(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """The counts kept so far; none before the first run."""
    if current(spark, layer_path(root, dataset)) is None:
        return spark.createDataFrame([], STATES)
    return read_layer(spark, root, dataset)


def refresh_states(
    spark: SparkSession, folder: str, root: str, dataset: str, counts: Callable[[DataFrame], Counts]
) -> DataFrame:
    """Bring the counts of a folder of Parquet files up to date, and return them.

    ``(path, length, modificationTime, run, complete, valid, cells)``, a row for each file; ``run`` is the number
    of the run that counted it. ``counts`` gives the counts to take of the table. They are kept as the layer table
    ``dataset`` below ``root`` and replaced in one step; a run that fails leaves them. Files without rows count 0.
    Names of files still to be counted pass through the driver, as they do in any read of them.
    """
    known = known_states(spark, root, dataset)
    files = stored(manifest(spark, folder, dataset, pattern="*.parquet").select(*FILE), "state-files")
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    new = stored(files.join(known.select(*FILE), FILE, "left_anti"), "new-files")
    kept = known.join(files, FILE, "left_semi")
    paths = [row["path"] for row in new.select("path").collect()]
    if paths:
        table = spark.read.schema(spark.read.parquet(folder).schema).option("basePath", folder).parquet(*paths)
        measured = table.groupBy(plain_path("_metadata.file_path").alias("path"))
        measured = measured.agg(*[c.cast("long").alias(name) for name, c in counts(table)._asdict().items()])
        fresh = new.join(measured, "path", "left").withColumn("run", F.lit(run).cast("long"))
        fresh = fresh.fillna(0, list(Counts._fields))
        kept = kept.unionByName(fresh.select(*known.columns))
    columns = spark.createDataFrame([], STATES).columns
    write_layer(kept.select(*columns), root, dataset)
    return read_layer(spark, root, dataset)


def shares_of_states(states: DataFrame) -> DataFrame:
    """One row ``(completeness, validity)`` of the whole table; 0.0 where nothing was counted."""
    total = F.sum("cells")
    return states.agg(
        share(F.sum("complete"), total).alias("completeness"), share(F.sum("valid"), total).alias("validity")
    )
