"""Comma-separated tables whose header has to be found first. Every cell is read as text."""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.text import strip
from strata.functions.values import without_sentinel
from strata.operators.select import small_side
from strata.session import stored
from strata.sources.lines import file_order, read_lines, without_blank_lines
from strata.sources.records import read_records

# The preamble's opening words and the missing mark of the monthly anomaly file.
PREAMBLE = "Land-Ocean"
MISSING_MARK = "***"


def header_names(line: str) -> list[str]:
    """Cells of a header line as unique names."""
    return unique_names(next(csv.reader([line])))


def unique_names(cells: Sequence[str]) -> list[str]:
    """Blanks get a numbered name, repeats a suffix."""
    names = []
    seen: Counter = Counter()
    for index, cell in enumerate(cells):
        name = cell.strip() or f"Unnamed: {index}"
        names.append(f"{name}.{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return names


def parse_cells(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Split each line into text cells; missing cells are NULL, surplus cells are dropped."""
    layout = ", ".join(f"_c{index} string" for index in range(len(names)))
    cells = F.from_csv(F.col("value"), layout, {"mode": "PERMISSIVE"})
    return lines.select(cells.alias("cells")).select("cells.*").toDF(*names)


def leading_rows(rows: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows of each file, numbered from 1 as ``line``. Only the start of a file is looked at, and tasks keep ``count`` rows a file.
    """
    in_file = Window.partitionBy("file_path").orderBy("block_start", "row_id")
    numbered = rows.where(F.col("block_start") == 0).withColumn("line", F.row_number().over(in_file))
    return numbered.where(F.col("line") <= count)


def without_rows(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows other than ``dropped``, told apart by where they stand and not by what they say."""
    place = ["file_path", "row_id"]
    return rows.join(small_side(dropped.select(*place)), place, "left_anti")


def read_anomaly_csv(
    spark: SparkSession, paths: str | Sequence[str], *, preamble: str = PREAMBLE
) -> DataFrame:
    """Wide monthly table: preamble and blank lines dropped, header resolved, cells as text.

    A file's first line is dropped if it starts with the preamble, and the line after that is the
    header; the same words further down are data. A folder may hold many files, each with its own
    preamble and header line; the headers must be equal.
    """
    lines = without_blank_lines(read_lines(spark, paths, position=True))
    leading = leading_rows(lines, 2)
    first = F.min(F.when(F.col("line") == 1, F.col("value"))).over(Window.partitionBy("file_path"))
    opened = first.startswith(F.lit(preamble))
    leading = leading.withColumn("header_line", F.when(opened, 2).otherwise(1))
    headers = leading.where("line = header_line").select(strip("value").alias("value")).distinct()
    head = [row["value"] for row in headers.limit(2).collect()]
    if not head:
        raise ValueError(f"no header line in {paths}")
    if len(head) > 1:
        raise ValueError(f"files disagree on the header line: {head}")
    rows = without_rows(lines, leading.where("line <= header_line"))
    return parse_cells(rows, header_names(head[0]))


def missing_marks_to_null(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The raw wide table with its missing marks as NULL, as quality scores need it."""
    marked = {name: without_sentinel(name, MISSING_MARK) for name in columns}
    return wide.withColumns(marked)


# A record without a cell that says anything: nothing but white space, quoted or not.
NO_CELLS = r'^\s*+("\s*+"\s*+)?$'


def read_sheet_csv(
    spark: SparkSession, paths: str | Sequence[str], *, header_row: int = 0
) -> DataFrame:
    """One sheet exported as CSV; ``header_row`` rows of text above the header are dropped.

    Cells and header names may hold line breaks within quotes; ``read_records`` finds the records of a file in all of its
    splits at once. Blank records do not count, and title rows and header are dropped by their place in each
    file; names come from the first. Rows come in file order. A quote that is never closed is an error.
    """
    records = read_records(read_lines(spark, paths, position=True, raw=True)).where(~F.col("value").rlike(NO_CELLS))
    leading = stored(leading_rows(records, header_row + 1), "leading-records")
    header = leading.where(F.col("line") == header_row + 1).orderBy("file_path").first()
    if header is None:
        raise ValueError(f"no header row {header_row} in {paths}")
    names = unique_names(next(csv.reader(io.StringIO(header["value"], newline=""))))
    layout = ", ".join(f"_c{index} string" for index in range(len(names)))
    cells = F.from_csv("value", layout, {"mode": "PERMISSIVE", "escape": '"', "lineSep": "\n"})
    rows = without_rows(records, leading).orderBy(*file_order())
    return rows.select(cells.alias("cells")).select("cells.*").toDF(*names)
