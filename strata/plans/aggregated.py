"""Aggregated layer: the unified trend, annual carbon means and the multi-source join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.aggregate import (
    in_order,
    mean_by,
    monthly_mean,
    union_by_name,
    yearly_mean,
)
from strata.operators.select import choose_match, equals_target, required_target
from strata.plans.cleaned import ANOMALY_TABLE, CARBON_TABLE, GRID_TABLE
from strata.sinks import read_layer, write_layer

# Where each table lies below the root of its layer.
TREND_TABLE = "climate/temp_trend"
CARBON_ANNUAL_TABLE = "climate/gcb_annual"
MULTI_SOURCE_TABLE = "climate/multi_source_join"

# Labels of the trend and the preferences for the joined variable and metric.
ANOMALY_SOURCE = "NASA_GISTEMP"
ANOMALY_VARIABLE = "temp_anomaly"
ANOMALY_UNIT = "C"
GRID_SOURCE = "ERA5"
GRID_PREFERENCES = ("t2m", "temp", "temperature", "tas")
CARBON_PREFERENCES = ("fossil", "co2", "emission", "total")


def temperature_trend(anomalies: DataFrame, grid: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Monthly anomalies and monthly grid means as one labelled series per source.

    Anomalies are taken row by row. In the sorted result, rows with equal keys stay in the order
    of the anomaly table, so that copies of one row can lie in several sort partitions.
    """
    monthly = anomalies.where(F.col("anomaly").isNotNull()).select(
        F.col("date").cast("date").alias("date"),
        F.lit(ANOMALY_SOURCE).alias("source"),
        F.lit(ANOMALY_VARIABLE).alias("variable"),
        F.lit(ANOMALY_UNIT).alias("unit"),
        F.col("anomaly").cast("double").alias("value"),
    )
    gridded = monthly_mean(grid, "time", ["variable", "units"], "value").select(
        "date",
        F.lit(GRID_SOURCE).alias("source"),
        "variable",
        F.col("units").alias("unit"),
        "value",
    )
    if not ordered:
        return schemas.conform(union_by_name(monthly, gridded), schemas.TREND)
    numbered = union_by_name(
        monthly.withColumn("row_id", F.monotonically_increasing_id()),
        gridded.withColumn("row_id", F.lit(0).cast("long")),
    )
    sorted_rows = in_order(numbered, "date", "source", "variable", "row_id")
    return schemas.conform(sorted_rows, schemas.TREND)


def annual_carbon(carbon: DataFrame, *, ordered: bool = True) -> DataFrame:
    annual = schemas.conform(mean_by(carbon, ["year", "metric"], "value"), schemas.CARBON_ANNUAL)
    return in_order(annual, "year", "metric") if ordered else annual


def multi_source_join(
    anomalies: DataFrame,
    grid: DataFrame,
    carbon: DataFrame,
    *,
    grid_target: str | None = None,
    carbon_target: str | None = None,
    grid_preferences: Sequence[str] = GRID_PREFERENCES,
    carbon_preferences: Sequence[str] = CARBON_PREFERENCES,
    ordered: bool = True,
) -> DataFrame:
    """Annual anomaly with the annual mean of one grid variable and one carbon metric.

    Each source is reduced to one row per year before it is joined. A target that is not given
    is chosen inside the plan and pushed into the scan of its table.
    """
    variable = grid_target or choose_match(grid, "variable", grid_preferences)
    metric = carbon_target or choose_match(carbon, "metric", carbon_preferences)
    by_year = mean_by(anomalies, ["year"], "anomaly", "nasa_anomaly")
    grid_by_year = yearly_mean(
        equals_target(grid, "variable", variable), "time", "value", "era5_value"
    )
    carbon_by_year = mean_by(
        equals_target(carbon, "metric", metric), ["year"], "value", "gcb_value"
    )
    joined = (
        by_year.join(grid_by_year, "year", "left")
        .join(carbon_by_year, "year", "left")
        .withColumns(
            {
                "era5_variable": required_target(variable, "no grid variable to join"),
                "gcb_metric": required_target(metric, "no carbon metric to join"),
            }
        )
    )
    joined = schemas.conform(joined, schemas.MULTI_SOURCE)
    return in_order(joined, "year") if ordered else joined


def serving_query(trend: DataFrame, source: str = ANOMALY_SOURCE) -> DataFrame:
    """Mean per date of one source; the source filter reaches the Parquet scan."""
    one = trend.where(F.col("source") == source)
    return in_order(mean_by(one, ["date"], "value", "avg_value"), "date")


def run_trend(spark: SparkSession, cleaned: str, root: str) -> DataFrame:
    trend = temperature_trend(
        read_layer(spark, cleaned, ANOMALY_TABLE),
        read_layer(spark, cleaned, GRID_TABLE),
    )
    return spark.read.parquet(write_layer(trend, root, TREND_TABLE))


def run_annual_carbon(spark: SparkSession, cleaned: str, root: str) -> DataFrame:
    annual = annual_carbon(read_layer(spark, cleaned, CARBON_TABLE))
    return spark.read.parquet(write_layer(annual, root, CARBON_ANNUAL_TABLE))


def run_multi_source(spark: SparkSession, cleaned: str, root: str) -> DataFrame:
    joined = multi_source_join(
        read_layer(spark, cleaned, ANOMALY_TABLE),
        read_layer(spark, cleaned, GRID_TABLE),
        read_layer(spark, cleaned, CARBON_TABLE),
    )
    return spark.read.parquet(write_layer(joined, root, MULTI_SOURCE_TABLE))
