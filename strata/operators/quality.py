"""Completeness and validity shares, each from one pass over a table, and their scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from strata.functions.text import quoted
from strata.functions.values import as_number, nan_to_null, share

# The plausible range of an anomaly.
LOWEST_ANOMALY = -5.0
HIGHEST_ANOMALY = 5.0


def _sum(columns: Sequence[Column]) -> Column:
    total = F.lit(0)
    for column in columns:
        total = total + column
    return total


class Counts(NamedTuple):
    """Aggregates over rows that add up over parts of a table: cells there are and that hold, and all of them."""

    complete: Column
    valid: Column
    cells: Column


def shares(df: DataFrame, counts: Counts) -> DataFrame:
    """One row ``(completeness, validity)``."""
    return df.agg(
        share(counts.complete, counts.cells).alias("completeness"),
        share(counts.valid, counts.cells).alias("validity"),
    )


def in_range(column: Column, lowest: float, highest: float) -> Column:
    return column.between(lowest, highest)


def wide_counts(
    wide: DataFrame,
    columns: Sequence[str],
    lowest: float = LOWEST_ANOMALY,
    highest: float = HIGHEST_ANOMALY,
) -> Counts:
    """All cells of several text columns: present, and numeric within a range."""
    cells = F.count(F.lit(1)) * F.lit(len(columns))
    present = _sum([F.count(quoted(name)) for name in columns])
    values = [as_number(wide, name) for name in columns]
    valid = _sum([F.count_if(in_range(value, lowest, highest)) for value in values])
    return Counts(present, valid, cells)


def wide_quality(wide: DataFrame, columns: Sequence[str], *bounds: float) -> DataFrame:
    return shares(wide, wide_counts(wide, columns, *bounds))


def range_counts(value: str, lowest: float = LOWEST_ANOMALY, highest: float = HIGHEST_ANOMALY) -> Counts:
    """Rows with the value present, and within a range; NULL counts as invalid."""
    within = F.count_if(in_range(F.col(value), lowest, highest))
    return Counts(F.count(value), within, F.count(F.lit(1)))


def range_quality(df: DataFrame, value: str, *bounds: float) -> DataFrame:
    return shares(df, range_counts(value, *bounds))


def numeric_quality(df: DataFrame) -> DataFrame:
    """Share of present cells over the numeric columns only; 0.0 if there are none."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cells = F.count(F.lit(1)) * F.lit(len(names))
    present = _sum([F.count(nan_to_null(quoted(name))) for name in names])
    return shares(df, Counts(present, present, cells))


def presence_counts(value: str) -> Counts:
    """Rows with a value, as complete and as valid ones."""
    return Counts(F.count(value), F.count(value), F.count(F.lit(1)))


def presence_quality(df: DataFrame, value: str) -> DataFrame:
    return shares(df, presence_counts(value))


def predicate_counts(value: Column, *others: Column) -> Counts:
    """Completeness: ``value`` holds. Validity: ``value`` and all ``others`` hold."""
    valid = value
    for other in others:
        valid = valid & other
    return Counts(F.count_if(value), F.count_if(valid), F.count(F.lit(1)))


def predicate_quality(df: DataFrame, value: Column, *others: Column) -> DataFrame:
    return shares(df, predicate_counts(value, *others))


def _parses(df: DataFrame, name: str, parse: Callable[[Column], Column]) -> Column:
    """A date or time is there; only text has to be parsed to know."""
    kind = df.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.col(name).isNotNull()
    text = F.col(name) if isinstance(kind, StringType) else F.col(name).cast("string")
    return parse(text).isNotNull()


def grid_counts(df: DataFrame) -> Counts:
    """Value numeric; valid if also the time parses and the variable is known."""
    return predicate_counts(
        as_number(df, "value").isNotNull(),
        _parses(df, "time", F.try_to_timestamp),
        F.col("variable").isNotNull(),
    )


def grid_quality(df: DataFrame) -> DataFrame:
    return shares(df, grid_counts(df))


def daily_counts(df: DataFrame, elements: Sequence[str]) -> Counts:
    """Value numeric; valid if also the date parses and the element is one of ``elements``."""
    return predicate_counts(
        as_number(df, "value").isNotNull(),
        _parses(df, "date", F.try_to_date),
        F.coalesce(F.col("element").isin(list(elements)), F.lit(False)),
    )


def daily_quality(df: DataFrame, elements: Sequence[str]) -> DataFrame:
    return shares(df, daily_counts(df, elements))


def score() -> Column:
    return F.lit(0.5) * F.col("completeness") + F.lit(0.5) * F.col("validity")


def scored(quality: DataFrame, dataset: str, layer: str) -> DataFrame:
    """``(dataset, layer, score)`` from one row of shares."""
    return quality.select(
        F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"), score().alias("score")
    )


def with_overall(scores: DataFrame) -> DataFrame:
    """Add the plain mean of the dataset scores of each layer as ``overall``, in one pass."""
    means = scores.rollup("layer", "dataset").agg(F.avg("score").alias("score"))
    named = F.coalesce(F.col("dataset"), F.lit("overall")).alias("dataset")
    return means.where(F.col("layer").isNotNull()).select(named, "layer", "score")


def score_table(scores: DataFrame) -> DataFrame:
    """One row per dataset with ``raw_score`` and ``silver_score``."""

    def of(layer: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col("score"))).alias(f"{layer}_score")

    return scores.groupBy("dataset").agg(of("raw"), of("silver"))
