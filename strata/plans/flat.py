"""The flat twin: the same tables in one SQL step from parsed input, without stored layers.

It is written apart from the layered plans so that comparing both checks each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.exact import exact_mean
from strata.plans.aggregated import (
    ANOMALY_SOURCE,
    ANOMALY_UNIT,
    ANOMALY_VARIABLE,
    CARBON_PREFERENCES,
    GRID_PREFERENCES,
    GRID_SOURCE,
)
from strata.sinks import replace_table, write_merged

# All readings as one series; those that the row number tells apart are not averaged with any other. Means of
# the flat tables are exact sums divided, as those of the layers are; all else is written apart.
TREND = """
    WITH readings AS (
        SELECT struct(:grid_source AS source, variable, units AS unit) AS label,
               trunc(CAST(time AS TIMESTAMP), 'MM') AS date, value AS reading, 0L AS number FROM {grid}
        UNION ALL
        SELECT struct(:anomaly_source, :anomaly_variable, :anomaly_unit), CAST(date AS DATE), anomaly,
               1 + monotonically_increasing_id() FROM {monthly} WHERE anomaly IS NOT NULL
    )
    SELECT date, label.*, number, reading AS value FROM readings
"""

# The position of the first preference a name contains; 0, for none, sorts behind the others.
CHOSEN = """
    SELECT min_by({column}, struct(
             coalesce(nullif(array_position(
               transform(:preferences, p -> contains(lower({column}), p)), true), 0), 1000000),
             {column})) AS target
    FROM (SELECT DISTINCT {column} FROM {table})
    WHERE {column} <> ''
"""

# The three series under one another, each row with its label; a year's row takes the means of the
# labels side by side. Only years of the anomalies are shown.
SERIES = """
    SELECT 'anomaly' AS label, year, anomaly AS value FROM {monthly}
    UNION ALL
    SELECT 'grid', year(CAST(time AS TIMESTAMP)), value FROM {grid}
    WHERE time IS NOT NULL AND variable = (FROM {grid_target})
    UNION ALL
    SELECT 'carbon', year, value FROM {carbon}
    WHERE year IS NOT NULL AND metric = (FROM {carbon_target})
"""
JOIN = """
    SELECT year,
           max(value) FILTER (WHERE label = 'anomaly') AS nasa_anomaly,
           max(value) FILTER (WHERE label = 'grid') AS era5_value,
           max(value) FILTER (WHERE label = 'carbon') AS gcb_value,
           (FROM {grid_target}) AS era5_variable,
           (FROM {carbon_target}) AS gcb_metric
    FROM {means}
    GROUP BY year
    HAVING count_if(label = 'anomaly') > 0
"""

DAILY = """
    SELECT station_id, CAST(date AS DATE) AS date, element, value, lat, lon, elevation, name
    FROM {daily}
"""


def flat_trend(monthly: DataFrame, grid: DataFrame) -> DataFrame:
    labels = {
        "anomaly_source": ANOMALY_SOURCE,
        "anomaly_variable": ANOMALY_VARIABLE,
        "anomaly_unit": ANOMALY_UNIT,
        "grid_source": GRID_SOURCE,
    }
    readings = monthly.sparkSession.sql(TREND, args=labels, monthly=monthly, grid=grid)
    return exact_mean(readings, ["date", "source", "variable", "unit", "number"], "value").drop("number")


def flat_annual(carbon: DataFrame) -> DataFrame:
    return exact_mean(carbon, ["year", "metric"], "value")


def flat_choice(table: DataFrame, column: str, preferences: Sequence[str]) -> DataFrame:
    listed = {"preferences": F.array(*[F.lit(p) for p in preferences])}
    return table.sparkSession.sql(CHOSEN, args=listed, column=F.col(column), table=table)


def flat_join(
    monthly: DataFrame,
    grid: DataFrame,
    carbon: DataFrame,
    *,
    grid_preferences: Sequence[str] = GRID_PREFERENCES,
    carbon_preferences: Sequence[str] = CARBON_PREFERENCES,
) -> DataFrame:
    spark = monthly.sparkSession
    targets = {
        "grid_target": flat_choice(grid, "variable", grid_preferences),
        "carbon_target": flat_choice(carbon, "metric", carbon_preferences),
    }
    series = spark.sql(SERIES, monthly=monthly, grid=grid, carbon=carbon, **targets)
    return spark.sql(JOIN, means=exact_mean(series, ["label", "year"], "value"), **targets)


def flat_daily(daily: DataFrame) -> DataFrame:
    """Station observations without their flags."""
    return daily.sparkSession.sql(DAILY, daily=daily)


def run_flat(
    monthly: DataFrame,
    grid: DataFrame,
    carbon: DataFrame,
    root: str,
    *,
    daily: DataFrame | None = None,
) -> dict[str, str]:
    """Build all flat tables, register each as a view and write it; returns their paths."""
    tables = {
        "temp_trend": flat_trend(monthly, grid),
        "gcb_annual": flat_annual(carbon),
        "multi_source_join": flat_join(monthly, grid, carbon),
    }
    if daily is not None:
        tables["noaa_daily"] = flat_daily(daily)
    return {
        name: write_merged(replace_table(table, name), f"{root.rstrip('/')}/{name}.parquet")
        for name, table in tables.items()
    }


def difference_counts(layered: DataFrame, flat: DataFrame) -> DataFrame:
    """One row: rows only in one of two tables, duplicates counted, in a single shuffle.

    Only counts are returned, so a large difference costs no more than a small one.
    """
    sides = layered.withColumn("side", F.lit(1)).unionByName(flat.withColumn("side", F.lit(-1)))
    balance = sides.groupBy(*layered.columns).agg(F.sum("side").alias("balance"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("balance", F.lit(0))), F.lit(0)).alias("only_layered"),
        F.coalesce(F.sum(F.greatest(-F.col("balance"), F.lit(0))), F.lit(0)).alias("only_flat"),
    )
