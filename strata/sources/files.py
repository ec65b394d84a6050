"""File listings as DataFrames, and the choice of which files to read."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.text import file_stem, plain_path
from strata.operators.select import keep_known
from strata.session import stored
from strata.sources.lines import read_lines


def manifest(
    spark: SparkSession, root: str, dataset: str, *, pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Path, size and time of every file below ``root``; file contents are not read.

    Spark makes no row of an empty file, so the empty ones are those that only the file index has;
    their time is not known.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(root)
        .select("path", "length", "modificationTime")
    )
    # Listed once; every use of the rows would otherwise ask for the state of every file again.
    names, files = files._jdf.inputFiles(), stored(files, "listing")
    if len(names) != files.count():
        indexed = spark.createDataFrame([(path,) for path in names], "indexed string")
        # The index writes an empty host as three slashes, the rows write one.
        plain = F.regexp_replace(plain_path("indexed"), "^([a-z0-9]+):///", "$1:/")
        indexed = indexed.select(plain.alias("path"))
        empty = indexed.join(files.select("path"), "path", "left_anti")
        files = files.unionByName(empty.withColumn("length", F.lit(0).cast("long")), allowMissingColumns=True)
    below = root.split("://", 1)[-1].removeprefix("file:").rstrip("/") + "/"
    start = F.locate(below, F.col("path")) + F.lit(len(below))
    relative = F.col("path").substr(start, F.length("path"))
    listed = files.select(
        F.lit(dataset).alias("dataset"),
        relative.alias("relative_path"),
        "path",
        "length",
        "modificationTime",
    )
    return schemas.conform(listed, schemas.MANIFEST)


def manifest_if_present(spark: SparkSession, root: str, dataset: str, **options) -> DataFrame:
    """``manifest``, or an empty listing when ``root`` does not exist."""
    try:
        return manifest(spark, root, dataset, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.MANIFEST)


def first_available(
    spark: SparkSession, dataset: str, candidates: Iterable[tuple[str, str]]
) -> DataFrame:
    """Listing of the files in the first ``(root, pattern)`` that has any, with that place.

    For example loose files before packed ones. Each place is listed once.
    """
    tried = []
    for root, pattern in candidates:
        files = manifest_if_present(spark, root, dataset, pattern=pattern)
        if not files.isEmpty():
            return files.withColumns({"root": F.lit(root), "pattern": F.lit(pattern)})
        tried.append(f"{root}/{pattern}")
    raise FileNotFoundError(f"no files for {dataset} in {', '.join(tried)}")


def missing_inputs(files: DataFrame, expected: DataFrame, key: str = "relative_path") -> DataFrame:
    """Expected names that have no file."""
    return expected.join(files.select(key).distinct(), key, "left_anti")


def require_inputs(files: DataFrame, expected: Sequence[str]) -> None:
    names = files.sparkSession.createDataFrame([(n,) for n in expected], "relative_path string")
    missing = [row["relative_path"] for row in missing_inputs(files, names).collect()]
    if missing:
        raise FileNotFoundError(f"missing required input: {', '.join(sorted(missing))}")


def preferred_files(files: DataFrame, stem: str = "stem", priority: str = "priority") -> DataFrame:
    """One path per stem: the lowest ``priority``, then the smallest path."""
    order = F.struct(F.col(priority), F.col("path"))
    return files.groupBy(stem).agg(F.min(order).getField("path").alias("path"))


def station_files(spark: SparkSession, roots: Sequence[str], pattern: str = "*.dly") -> DataFrame:
    """``(stem, path)`` of the daily files directly in ``roots``, earlier roots first."""
    listings = [
        manifest_if_present(spark, root, "daily", pattern=pattern, recursive=False).select(
            file_stem("path").alias("stem"), F.lit(order).alias("priority"), "path"
        )
        for order, root in enumerate(roots)
    ]
    found = listings[0]
    for listing in listings[1:]:
        found = found.unionByName(listing)
    return preferred_files(found)


def require_files(files: DataFrame) -> None:
    if files.isEmpty():
        raise FileNotFoundError("no data files for the selected stations")


def read_selected_files(spark: SparkSession, files: DataFrame, roots: Sequence[str]) -> DataFrame:
    """Lines of the files in ``files``, with ``file_stem``.

    The roots are read whole and lines of other files are left out by a join on the path: the paths are
    broadcast where their size allows it, and where it does not, large files are dealt to several tasks. Where few of
    many files are wanted, landed lines are the better source: they lie in folders by prefix, of which
    only the wanted ones are read.
    """
    present = [
        root
        for root in roots
        if not manifest_if_present(spark, root, "daily", recursive=False).isEmpty()
    ]
    lines = read_lines(spark, present, recursive=False)
    return of_files(lines, files)


def of_paths(lines: DataFrame, files: DataFrame) -> DataFrame:
    """The lines that come from ``files``."""
    return keep_known(lines, files.select(F.col("path").alias("file_path")), "file_path")


def of_files(lines: DataFrame, files: DataFrame) -> DataFrame:
    """The lines that come from ``files``, with ``file_stem``."""
    return of_paths(lines, files).withColumn("file_stem", file_stem("file_name"))
