"""Aggregated tables, chosen targets, unions and the flat twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.aggregate import (
    distinct_values,
    in_order,
    mean_by,
    monthly_mean,
    union_by_position,
    yearly_mean,
)
from strata.operators.select import choose_match, equals_target, required_target
from strata.plans.aggregated import (
    annual_carbon,
    multi_source_join,
    run_annual_carbon,
    run_multi_source,
    run_trend,
    serving_query as serving,
    temperature_trend,
)
from strata.plans.cleaned import ANOMALY_TABLE, CARBON_TABLE, GRID_TABLE
from strata.plans.flat import difference_counts, flat_annual as flat_annual_table, run_flat
from strata.plans.flat import flat_join as flat_join_table
from strata.plans.flat import flat_trend as flat_trend_table
from strata.session import shared_folder
from strata.sinks import read_layer, replace_table, write_layer
from strata.sources.tables import from_records, read_first_parquet, read_parquet
from workload import shapes
from workload.registry import query
from workload.shapes import ANOMALIES_SQL, CARBON_SQL, GRID_SQL, rounded, table

# One series of readings. A station reading has a number of its own and so is a mean by itself; all grid
# readings of a month share the number 0.
TREND_SQL = f"""
    SELECT * EXCLUDE (number) FROM (
        SELECT number, source, variable, unit, CAST(day AS DATE) AS date, round(avg(reading), 4) AS value
        FROM (
            SELECT 0 AS number, 'ERA5' AS source, variable, units AS unit,
                   date_trunc('month', time) AS day, value AS reading FROM ({GRID_SQL})
            UNION ALL BY NAME
            SELECT row_number() OVER () AS number, 'NASA_GISTEMP' AS source, 'C' AS unit,
                   'temp_anomaly' AS variable, date AS day, anomaly AS reading FROM ({ANOMALIES_SQL})
        ) GROUP BY ALL
    ) WHERE number = 0 OR value IS NOT NULL
"""
ANNUAL_SQL = f"""
    SELECT year, metric, round(avg(value), 4) AS value FROM ({CARBON_SQL}) GROUP BY year, metric
"""


def _join_sql(grid_sql: str, variable: str, metric: str) -> str:
    """Means by year and series, turned so that the series are columns."""
    return f"""
        PIVOT (
            SELECT CAST(year AS INT) AS year, 'nasa_anomaly' AS series, anomaly AS v
            FROM ({ANOMALIES_SQL})
            UNION ALL
            SELECT year(time), 'era5_value', value FROM ({grid_sql}) WHERE variable = '{variable}'
            UNION ALL
            SELECT year, 'gcb_value', value FROM ({CARBON_SQL}) WHERE metric = '{metric}'
        )
        ON series IN ('nasa_anomaly', 'era5_value', 'gcb_value') USING round(avg(v), 4)
        GROUP BY year
    """


def _join_query(*parts: str) -> str:
    _, variable, metric = parts
    return f"""
        SELECT * REPLACE (CAST(year AS INT) AS year), '{variable}' AS era5_variable, '{metric}' AS gcb_metric
        FROM ({_join_sql(*parts)})
        WHERE year IN (SELECT year FROM ({ANOMALIES_SQL}))
    """


@query(TREND_SQL)
def trend_union(spark, sf_dir):
    trend = temperature_trend(shapes.anomalies(spark, sf_dir), shapes.grid(spark, sf_dir))
    return rounded(trend, "value")


@query(ANNUAL_SQL)
def annual_by_metric(spark, sf_dir):
    return rounded(annual_carbon(shapes.carbon(spark, sf_dir)), "value")


def _rounded_join(joined):
    return rounded(joined, "nasa_anomaly", "era5_value", "gcb_value")


@query(_join_query(GRID_SQL, "t2m", "fossil_emissions"))
def annual_left_join(spark, sf_dir):
    parts = (shapes.anomalies, shapes.grid, shapes.carbon)
    return _rounded_join(multi_source_join(*[part(spark, sf_dir) for part in parts]))


@query(
    _join_query(
        "SELECT ts AS time, event_type AS variable, value FROM events", "click", "ocean_sink"
    )
)
def annual_left_join_unmatched(spark, sf_dir):
    """No preference matches and no year of the events has orders."""
    events = table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"), F.col("event_type").alias("variable"), "value"
    )
    joined = multi_source_join(
        shapes.anomalies(spark, sf_dir),
        events,
        shapes.carbon(spark, sf_dir),
        carbon_target="ocean_sink",
    )
    return _rounded_join(joined)


@query(f"""
    SELECT date, round(avg(anomaly), 4) AS avg_value
    FROM ({ANOMALIES_SQL}) WHERE anomaly IS NOT NULL GROUP BY date
""")
def serving_query(spark, sf_dir):
    trend = temperature_trend(
        shapes.anomalies(spark, sf_dir), shapes.grid(spark, sf_dir), ordered=False
    )
    return rounded(serving(trend), "avg_value")


@query(f"""
    SELECT date, round(avg(value), 4) AS avg_value
    FROM ({TREND_SQL}) WHERE source = 'ERA5' GROUP BY date
""")
def serving_query_on_stored_trend(spark, sf_dir):
    """The serving query on the trend as written, read from the first place that has it."""
    trend = temperature_trend(shapes.anomalies(spark, sf_dir), shapes.grid(spark, sf_dir))
    root = shared_folder(spark, "trend")
    path = write_layer(rounded(trend, "value"), root, "climate/temp_trend")
    stored = read_first_parquet(spark, [f"{root}/near", path])
    return rounded(serving(stored, "ERA5"), "avg_value")


@query("SELECT 'signup' AS event_type")
def choose_target(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return choose_match(events, "event_type", ["refund", "sign", "view"], alias="event_type")


@query("SELECT min(p_type) AS p_type, min(p_name) AS p_name FROM part")
def choose_target_without_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    types = choose_match(part, "p_type", ["fossil", "co2"], alias="p_type")
    names = choose_match(part, "p_name", [])
    return types.withColumn("p_name", required_target(names, "no part name"))


def _event_cents(spark, sf_dir):
    days = {"date": F.to_date("ts"), "value": shapes.cents("value")}
    return table(spark, sf_dir, "events").withColumns(days)


@query("""
    SELECT CAST(ts AS DATE) AS date, round(avg(round(value * 100)), 4) AS value
    FROM events WHERE event_type = 'purchase' GROUP BY 1
""")
def mean_of_chosen_target(spark, sf_dir):
    events = _event_cents(spark, sf_dir)
    target = choose_match(events, "event_type", ["purch"])
    chosen = equals_target(events, "event_type", target)
    return rounded(mean_by(chosen, ["date"], "value"), "value")


@query(f"""
    SELECT CAST(date_trunc('month', time) AS DATE) AS date, variable, units,
           round(avg(value), 4) AS value
    FROM ({GRID_SQL}) GROUP BY 1, 2, 3
""")
def monthly_mean_with_null_units(spark, sf_dir):
    means = monthly_mean(shapes.grid(spark, sf_dir), "time", ["variable", "units"], "value")
    return rounded(means, "value")


@query(f"SELECT year, round(avg(anomaly), 4) AS mean FROM ({ANOMALIES_SQL}) GROUP BY year")
def mean_by_year(spark, sf_dir):
    return rounded(mean_by(shapes.anomalies(spark, sf_dir), ["year"], "anomaly", "mean"), "mean")


@query("""
    SELECT CAST(year(l_shipdate) AS INT) AS year, round(avg(l_quantity), 4) AS quantity
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
""")
def mean_by_year_of_one_source(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return rounded(yearly_mean(returned, "l_shipdate", "l_quantity", "quantity"), "quantity")


@query("SELECT DISTINCT l_shipdate FROM lineitem")
def distinct_dates(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("""
    SELECT 'customer' AS source, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier
""")
def union_of_positions(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("source"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier"), "s_name", "s_acctbal")
    return union_by_position(customers, suppliers)


@query("SELECT event_id, user_id, event_type, value FROM events")
def many_paths_one_table(spark, sf_dir):
    """Two stored folders of one table read back as one."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    root = shared_folder(spark, "events")
    errors = F.col("event_type") == "error"
    paths = [
        write_layer(events.where(errors), root, "errors"),
        write_layer(events.where(~errors), root, "others"),
    ]
    return read_parquet(spark, *paths)


@query("""
    SELECT CAST(ts AS DATE) AS date, event_type, round(avg(round(value * 100)), 4) AS value
    FROM events GROUP BY 1, 2 ORDER BY 1, 2
""")
def ordered_means(spark, sf_dir):
    means = mean_by(_event_cents(spark, sf_dir), ["date", "event_type"], "value")
    return in_order(rounded(means, "value"), "date", "event_type")


UNITS = [
    ("land_use", "t", 1.0),
    ("fossil_emissions", "Gt", float("nan")),
    ("ocean_sink", None, 2.0),
]


@query(f"""
    SELECT c.metric, u.unit, u.factor, count(*) AS n
    FROM ({CARBON_SQL}) c
    LEFT JOIN (VALUES ('land_use', 't', 1.0::DOUBLE), ('fossil_emissions', 'Gt', NULL),
                      ('ocean_sink', NULL, 2.0)) u(metric, unit, factor) ON u.metric = c.metric
    GROUP BY ALL
""")
def labelled_by_records(spark, sf_dir):
    """Long metrics labelled from a small table of records, whose NaN reads as NULL."""
    units = from_records(spark, UNITS, "metric string, unit string, factor double")
    counts = shapes.carbon(spark, sf_dir).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(units, "metric", "left").select("metric", "unit", "factor", "n")


@query(TREND_SQL)
def flat_trend(spark, sf_dir):
    flat = flat_trend_table(shapes.anomalies(spark, sf_dir), shapes.grid(spark, sf_dir))
    return rounded(flat, "value")


@query(ANNUAL_SQL)
def flat_annual(spark, sf_dir):
    flat = flat_annual_table(shapes.carbon(spark, sf_dir))
    return rounded(replace_table(flat, "gcb_annual"), "value")


@query(_join_query(GRID_SQL, "t2m", "fossil_emissions"))
def flat_join(spark, sf_dir):
    parts = (shapes.anomalies, shapes.grid, shapes.carbon)
    return _rounded_join(flat_join_table(*[part(spark, sf_dir) for part in parts]))


@query(
    "SELECT * FROM (VALUES ('annual', 0::BIGINT, 0::BIGINT), ('join', 0, 0), ('trend', 0, 0)) "
    "v(name, only_layered, only_flat)"
)
def layered_equals_flat(spark, sf_dir):
    """Rows that only the layered or only the flat tables have, bit by bit.

    The flat side is dealt to another number of partitions, which the means must not show.
    """
    parts = [part(spark, sf_dir) for part in (shapes.anomalies, shapes.grid, shapes.carbon)]
    monthly, grid, carbon = parts
    dealt = [part.repartition(7) for part in parts]
    pairs = {
        "annual": (annual_carbon(carbon, ordered=False), flat_annual_table(dealt[2])),
        "join": (multi_source_join(monthly, grid, carbon, ordered=False), flat_join_table(*dealt)),
        "trend": (temperature_trend(monthly, grid, ordered=False), flat_trend_table(*dealt[:2])),
    }
    counts = [
        difference_counts(layered, flat).withColumn("name", F.lit(name))
        for name, (layered, flat) in pairs.items()
    ]
    return union_by_position(*counts)


@query(
    "SELECT * FROM (VALUES ('gcb_annual', 0::BIGINT, 0::BIGINT), ('multi_source_join', 0, 0), "
    "('temp_trend', 0, 0)) v(name, only_layered, only_flat)"
)
def stored_layers_equal_flat_job(spark, sf_dir):
    """The tables that the flat job writes against the stored tables of the layered jobs, bit by bit."""
    root = shared_folder(spark, "both")
    silver, gold = f"{root}/silver", f"{root}/gold"
    parts = [part(spark, sf_dir) for part in (shapes.anomalies, shapes.grid, shapes.carbon)]
    for part, name in zip(parts, (ANOMALY_TABLE, GRID_TABLE, CARBON_TABLE), strict=True):
        write_layer(part, silver, name)
    layered = {
        "temp_trend": run_trend(spark, silver, gold),
        "gcb_annual": run_annual_carbon(spark, silver, gold),
        "multi_source_join": run_multi_source(spark, silver, gold),
    }
    stored = [read_layer(spark, silver, name) for name in (ANOMALY_TABLE, GRID_TABLE, CARBON_TABLE)]
    paths = run_flat(*stored, f"{root}/flat")

    counts = [
        difference_counts(table, spark.read.parquet(paths[name])).withColumn("name", F.lit(name))
        for name, table in layered.items()
    ]
    return union_by_position(*counts)
