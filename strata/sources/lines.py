"""Raw text files as a DataFrame of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import is_blank, plain_path

POSITION = ("file_path", "block_start", "row_id")


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    pattern: str | None = None,
    recursive: bool = True,
    position: bool = False,
    raw: bool = False,
) -> DataFrame:
    """Lines of text files with the path and name of the file each came from.

    ``raw`` lines end at line feeds only and keep all their bytes, a carriage return at their end
    and bytes that are no text included.

    With ``position`` the columns of ``POSITION`` order the lines as they stand in their files.
    Spark splits files freely; within one split ``row_id`` grows line by line, so path, split
    offset and ``row_id`` together give file order without numbering lines on one task.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if raw:
        reader = reader.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    columns = [
        F.col("value"),
        plain_path("_metadata.file_path").alias("file_path"),
        plain_path("_metadata.file_name").alias("file_name"),
    ]
    if position:
        columns += [
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("row_id"),
        ]
    return reader.text([paths] if isinstance(paths, str) else list(paths)).select(*columns)


def without_blank_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~is_blank("value"))


def file_order() -> list[Column]:
    return [F.col(name) for name in POSITION]


def leading_lines(lines: DataFrame, count: int) -> list[str]:
    """The first ``count`` lines of one file, for reading a header while the plan is built.

    Only lines of a file's first split qualify, and Spark stops after the first partitions.
    """
    head = lines.where(F.col("block_start") == 0).select("value", "file_path")
    return [row["value"] for row in head.limit(count).collect()]
