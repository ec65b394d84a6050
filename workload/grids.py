"""Grid cells reduced to one mean per time step."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.aggregate import grid_mean_of_arrays
from strata.plans.cleaned import clean_grid, run_grid
from strata.session import shared_folder
from workload import shapes
from workload.registry import query
from workload.shapes import GRID_SQL, rounded, table


@query("""
    SELECT vec_id, label, round(avg(CASE WHEN cell <= 0.1::FLOAT THEN cell::DOUBLE END), 4) AS value
    FROM (SELECT vec_id, label, unnest(embedding) AS cell FROM embeddings)
    GROUP BY vec_id, label
""")
def grid_mean_of_array_rows(spark, sf_dir):
    """Arrays of cells; those above 0.1 are masked as NaN."""
    masked = F.transform(
        "embedding",
        lambda cell: F.when(cell <= F.lit(0.1).cast("float"), cell.cast("double")).otherwise(
            F.lit(float("nan"))
        ),
    )
    arrays = table(spark, sf_dir, "embeddings").withColumn("cells", masked)
    return rounded(grid_mean_of_arrays(arrays, ["vec_id", "label"], "cells"), "value")


@query(f"""
    SELECT time, variable, round(avg(CASE WHEN value >= 2000000 THEN value END), 4) AS value, units,
           'cells.nc' AS source_file
    FROM ({GRID_SQL}) GROUP BY time, variable, units
""")
def grid_means(spark, sf_dir):
    """Line items as cells, small ones masked as NaN, with coordinate rows among them."""
    return _ntz(clean_grid(_cells(spark, sf_dir)))


@query(f"""
    SELECT time, variable, round(avg(CASE WHEN value >= 2000000 THEN value END), 4) AS value, units,
           'cells.nc' AS source_file
    FROM ({GRID_SQL}) GROUP BY time, variable, units
""")
def grid_job(spark, sf_dir):
    """The same, stored as the cleaned table and read back."""
    return _ntz(run_grid(_cells(spark, sf_dir), shared_folder(spark, "grid")))


def _cells(spark, sf_dir):
    cells = shapes.grid(spark, sf_dir)
    masked = F.when(F.col("value") >= 2000000, F.col("value")).otherwise(F.lit(float("nan")))
    cells = cells.withColumns({"value": masked, "source_file": F.lit("cells.nc")})
    coordinates = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("time"),
        F.when(F.col("o_orderstatus") == "P", "latitude").otherwise("expver").alias("variable"),
        F.lit(None).cast("string").alias("units"),
        F.col("o_totalprice").alias("value"),
        F.lit("cells.nc").alias("source_file"),
    )
    return cells.unionByName(coordinates)


def _ntz(means):
    return rounded(means, "value").withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("""
    SELECT date_trunc('second', ts) AS time, event_type AS variable, round(avg(value), 4) AS value,
           CASE WHEN event_type = 'click' THEN NULL ELSE 'n' END AS units,
           'user-' || user_id % 3 AS source_file
    FROM events GROUP BY ALL
""")
def grid_means_by_second(spark, sf_dir):
    """Times with a sub-second part, several source files."""
    cells = table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"),
        F.col("event_type").alias("variable"),
        F.when(F.col("event_type") != "click", "n").alias("units"),
        "value",
        F.concat(F.lit("user-"), F.pmod("user_id", F.lit(3))).alias("source_file"),
    )
    return _ntz(clean_grid(cells))
