"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import shared_folder

# Of this many tasks none should have to take the rows of one key on its own: keys with more than a task's share of the
# rows are heavy, so there are fewer heavy keys than this.
SHARES = 200

# Rows that one window or one task is meant to hold at most.
ROWS_PER_GROUP = 4_000


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    What follows starts from files every executor can reach, so a lost executor costs no more than
    its own tasks, and a table used twice is computed once.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join of ``rows`` with at most one row of ``facts`` for each key, wherever the rows of heavy keys lie.

    Facts of heavy keys, fewer than ``SHARES``, are broadcast, and their rows stay where they are; the others are
    shuffled by key. Both sides are read more than once, so they should be settled. Rows without a key get no facts.
    """
    counts = settle(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).scalar()
    heavy = settle(counts.where(F.col(key).isNotNull() & (F.col("_n") * SHARES > total)).select(key), "heavy-keys")
    few = F.broadcast(heavy)
    dealt = rows.join(few, key, "left_semi").join(F.broadcast(facts.join(few, key, "left_semi")), key, "left")
    return rows.join(few, key, "left_anti").join(facts, key, "left").unionByName(dealt)


def text_or_empty(name: str = "text") -> Column:
    """The text column, NULL counting as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bits_for(rows: int, per_group: int = ROWS_PER_GROUP) -> int:
    """How many leading bits of a hash split ``rows`` rows into groups of about ``per_group``."""
    return min(30, max(2, (max(rows, 1) // per_group).bit_length() + 1))


def numbered(rows: DataFrame, group: list[str], cell: str, order: list, name: str) -> DataFrame:
    """Add ``name``, the 0-based place of a row in its group, and ``<name>_of``, the group's size.

    Cells cut a group along its order. Their sizes are counted with a partial aggregate and summed up
    before each cell; only the rows of one cell are sorted together.
    """
    cells = rows.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(
        *group,
        cell,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(whole).alias(f"{name}_of"),
    )
    place = F.row_number().over(Window.partitionBy(*group, cell).orderBy(*order)) - 1
    numbered = rows.withColumn("_place", place).join(starts, [*group, cell])
    return numbered.withColumn(name, F.col("_start") + F.col("_place")).drop("_start", "_place")
