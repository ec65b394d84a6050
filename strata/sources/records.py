"""Records of comma-separated files, whose quoted cells may hold line breaks, read by many tasks.

A line on its own does not tell whether it begins within a quoted cell. It does tell how it would end if it
began within one, and if it did not. Such pairs of answers are put together in order, first over the lines of a split,
then over the splits of a file, so no task needs more than the lines of one split or one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.select import small_side
from strata.session import stored

LINE = ["file_path", "block_start", "row_id"]
SPLIT = ["file_path", "block_start"]


def _ends_within(line: Column, within: bool, separator: str) -> Column:
    """Whether a line ends within a quoted cell, when it begins within one or does not.

    A quote opens a cell only at its start and is an ordinary character elsewhere in an unquoted one. Within a
    quoted cell every odd number of quotes closes it, as doubled ones stand for themselves.
    """

    def step(state: Column, piece: Column) -> Column:
        odd = F.length(piece) - F.length(F.replace(piece, F.lit('"'), F.lit("")))
        odd = odd % 2 == 1
        return F.when(state, ~odd).otherwise(odd & piece.startswith('"'))

    pieces = F.split(line, f"[{separator}]", -1)
    return F.when(~F.contains(line, F.lit('"')), F.lit(within)).otherwise(F.aggregate(pieces, F.lit(within), step))


def _entered(df: DataFrame, group: list[str], order: str, ends: tuple[str, str]) -> DataFrame:
    """Add ``in_0`` and ``in_1``: whether each row begins within a quote, if its group does not or does.

    ``ends`` names the columns with how a row ends from either beginning. Rows that end alike from both fix the
    state for the rows behind them, and of the others those that change it are counted.
    """
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out, within = (F.col(name) for name in ends)
    turns = F.coalesce(F.sum(F.when(out & ~within, 1).otherwise(0)).over(before), F.lit(0)).alias("turns")
    rows = df.select("*", turns)
    fixed = F.when(out == within, F.struct(F.col(order), out.cast("int").alias("state"), "turns"))
    rows = rows.select("*", F.max(fixed).over(before).alias("fixed"))
    for start in (0, 1):
        since = F.coalesce(F.col("fixed.state") + F.col("turns") - F.col("fixed.turns"), F.col("turns") + start)
        rows = rows.withColumn(f"in_{start}", since % 2 == 1)
    return rows.drop("turns", "fixed")


def _line_states(lines: DataFrame, separator: str) -> DataFrame:
    """Lines with their states and with the line of their split that opens their record, for both beginnings."""
    ends = [_ends_within(F.col("value"), bool(start), separator).alias(f"out_{start}") for start in (0, 1)]
    rows = _entered(lines.select(*LINE, "value", *ends), SPLIT, "row_id", ("out_0", "out_1"))
    so_far = Window.partitionBy(*SPLIT).orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    for start in (0, 1):
        state = F.col(f"in_{start}")
        rows = rows.withColumn(f"opened_{start}", F.max(F.when(~state, F.col("row_id"))).over(so_far))
        rows = rows.withColumn(f"end_{start}", F.when(state, F.col("out_1")).otherwise(F.col("out_0")))
    return rows.drop("out_0", "out_1")


def _split_states(rows: DataFrame) -> DataFrame:
    """``(file_path, block_start, within, carried)``, a row for each split.

    ``within`` says whether the split begins within a quoted cell, and ``carried`` is the line before it that opens the
    record its first lines belong to. A file whose last quote is never closed is an error.
    """
    last = [F.max_by(f"end_{start}", "row_id").alias(f"end_{start}") for start in (0, 1)]
    opened = [F.max(f"opened_{start}").alias(f"opened_{start}") for start in (0, 1)]
    splits = _entered(rows.groupBy(*SPLIT).agg(*last, *opened), ["file_path"], "block_start", ("end_0", "end_1"))
    within = F.col("in_0")
    splits = splits.select(
        *SPLIT,
        within.alias("within"),
        F.when(within, F.col("end_1")).otherwise(F.col("end_0")).alias("unclosed"),
        F.when(within, F.col("opened_1")).otherwise(F.col("opened_0")).alias("opened"),
    )
    before = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    line = F.when(F.col("opened").isNotNull(), F.struct("block_start", F.col("opened").alias("row_id")))
    splits = stored(splits.withColumn("carried", F.max(line).over(before)), "record-splits")
    ending = splits.groupBy("file_path").agg(F.max_by("unclosed", "block_start").alias("unclosed"))
    broken = ending.where("unclosed").first()
    if broken:
        raise ValueError(f"a quote is never closed in {broken['file_path']}")
    return splits.drop("unclosed", "opened")


def read_records(lines: DataFrame, *, separator: str = ",") -> DataFrame:
    """``(file_path, block_start, row_id, value)`` of every record: its text and the place of its first line.

    ``lines`` are raw lines with their position. Lines end at ``\\n`` or ``\\r\\n``; the end of a record is dropped, those
    within it stay. Records of one line, which are nearly all, are not moved once their state is known; the lines of
    longer ones meet by record. A record is as long as its cells are. Files without lines give no records, NULL lines
    none either, and blank lines outside of quotes are records of their own.
    """
    rows = stored(_line_states(lines.where(F.col("value").isNotNull()), separator), "record-lines")
    rows = rows.join(small_side(_split_states(rows)), SPLIT)
    picked = {
        name: F.when(F.col("within"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
        for name in ("in", "end", "opened")
    }
    here = F.when(picked["opened"].isNotNull(), F.struct("block_start", picked["opened"].alias("row_id")))
    rows = rows.select(
        *LINE, "value", picked["in"].alias("begun"), picked["end"].alias("goes_on"),
        F.coalesce(here, F.col("carried")).alias("opener"),
    )
    single = rows.where("not begun and not goes_on").select(*LINE, "value")
    parts = F.array_sort(F.collect_list(F.struct("block_start", "row_id", "value")))
    several = rows.where("begun or goes_on").groupBy("file_path", "opener").agg(parts.alias("parts"))
    several = several.select(
        "file_path", "opener.block_start", "opener.row_id", F.array_join("parts.value", "\n").alias("value")
    )
    ended = F.regexp_replace("value", "\\r$", "")
    return single.unionByName(several).withColumn("value", ended)
