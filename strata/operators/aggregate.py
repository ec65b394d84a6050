"""Means, distinct values, unions and ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import month_bucket
from strata.functions.text import as_column
from strata.functions.values import nan_to_null
from strata.operators.exact import exact_mean

# Names of a grid file that are coordinates, not data.
COORDINATES = (
    "time",
    "valid_time",
    "latitude",
    "longitude",
    "lat",
    "lon",
    "number",
    "expver",
)


def mean_by(
    df: DataFrame, keys: Sequence[str | Column], value: str, alias: str | None = None
) -> DataFrame:
    """Mean per key, NULLs ignored, NULL keys a group of their own.

    Every task first reduces its rows to a few sums and counts per key, so a key that holds most of
    the rows costs the shuffle no more than any other. The sums are exact: the mean has the same bits
    however the rows are dealt.
    """
    return exact_mean(df, keys, value, alias)


def yearly_mean(df: DataFrame, time: str, value: str, alias: str) -> DataFrame:
    return mean_by(df, [F.year(time).alias("year")], value, alias)


def monthly_mean(df: DataFrame, time: str, keys: Sequence[str], value: str) -> DataFrame:
    return mean_by(df, [month_bucket(time).alias("date"), *keys], value)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def data_variables(grid: DataFrame, variable: str = "variable") -> DataFrame:
    """Grid rows of data variables, without coordinates."""
    return grid.where(~F.col(variable).isin(*COORDINATES))


def grid_mean(cells: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Unweighted mean over all cells of a key; NaN cells are ignored, all NaN gives NULL."""
    return exact_mean(cells.withColumn(value, nan_to_null(value)), keys, value)


def grid_mean_of_arrays(
    arrays: DataFrame, keys: Sequence[str], cells: str, value: str = "value"
) -> DataFrame:
    """``grid_mean`` for rows that hold many cells as an array; a key may have many rows."""
    exploded = arrays.select(*keys, F.explode(cells).alias(value))
    return grid_mean(exploded, keys, value)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def union_by_position(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.union(other)
    return first


def in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order of an aggregated result, whose keys are nearly unique."""
    return df.orderBy(*keys)


def in_stable_order(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order of observations; equal keys keep the order in which they were read.

    The row id makes sort keys unique, so the range partitioning behind the sort can split a key
    that holds a large part of the rows. Only for rows that come straight from a scan: there the
    id is the same when a lost task runs again.
    """
    return rows.orderBy(*[as_column(k) for k in keys], F.monotonically_increasing_id())
