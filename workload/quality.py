"""Quality shares and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.dates import MONTH_NAMES
from strata.functions.values import number
from strata.operators.quality import (
    daily_quality,
    grid_quality,
    numeric_quality,
    presence_quality,
    range_counts,
    range_quality,
    score,
    score_table,
    wide_quality,
)
from strata.operators.slots import decode_daily_lines
from strata.operators.states import refresh_states, shares_of_states
from strata.plans.cleaned import DAILY_TABLE, clean_anomalies, clean_carbon, clean_grid
from strata.plans.evaluation import quality_scores
from strata.session import shared_folder
from strata.sinks import write_layer
from strata.sources.delimited import MISSING_MARK, missing_marks_to_null
from workload import shapes
from workload.registry import query
from workload.shapes import DAILY_SQL, GRID_SQL, WIDE_LONG_SQL, rounded, table

SHARES = ("completeness", "validity")
WIDE_RANGE = (100_000.0, 300_000.0)


@query(f"""
    WITH {WIDE_LONG_SQL}
    SELECT round(count(v) / count(*), 6) AS completeness,
           round(count(*) FILTER (v BETWEEN 100000 AND 300000) / count(*), 6) AS validity
    FROM cells
""")
def quality_wide(spark, sf_dir):
    wide = missing_marks_to_null(shapes.wide_months(spark, sf_dir), MONTH_NAMES)
    return rounded(wide_quality(wide, MONTH_NAMES, *WIDE_RANGE), *SHARES, digits=6)


@query(f"""
    WITH {WIDE_LONG_SQL}
    SELECT round(count(v) / count(*), 6) AS completeness,
           round(count(*) FILTER (v BETWEEN 100000 AND 300000) / count(*), 6) AS validity
    FROM cells
""")
def quality_range(spark, sf_dir):
    long = clean_anomalies(shapes.wide_months(spark, sf_dir), ordered=False)
    return rounded(range_quality(long, "anomaly", *WIDE_RANGE), *SHARES, digits=6)


@query("""
    SELECT round((count(*) * 2 + count(*) FILTER (c_acctbal >= 0)) / (3 * count(*)), 6)
             AS completeness,
           round((count(*) * 2 + count(*) FILTER (c_acctbal >= 0)) / (3 * count(*)), 6) AS validity
    FROM customer
""")
def quality_of_numeric_columns(spark, sf_dir):
    """Three numeric columns, debts missing; text columns do not count."""
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    )
    return rounded(numeric_quality(customers), *SHARES, digits=6)


@query("SELECT 0.0::DOUBLE AS completeness, 0.0::DOUBLE AS validity FROM region LIMIT 1")
def quality_without_numeric_columns(spark, sf_dir):
    return numeric_quality(table(spark, sf_dir, "documents").select("text", "lang"))


@query("""
    SELECT round(count(*) FILTER (quality = 1) / count(*), 6) AS completeness,
           round(count(*) FILTER (quality = 1) / count(*), 6) AS validity
    FROM labels
""")
def quality_of_presence(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("quality", F.nullif("quality", F.lit(0)))
    return rounded(presence_quality(labels, "quality"), *SHARES, digits=6)


@query("""
    SELECT round(count(*) FILTER (event_type <> 'error') / count(*), 6) AS completeness,
           round(count(*) FILTER (event_type NOT IN ('error', 'view', 'signup')) / count(*), 6)
             AS validity
    FROM events
""")
def quality_of_predicate(spark, sf_dir):
    """Errors have no number, views no time and signups no variable."""
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        F.when(kind == "error", "broken").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "view", "noon").otherwise(F.col("ts").cast("string")).alias("time"),
        F.when(kind != "signup", kind).alias("variable"),
    )
    return rounded(grid_quality(events), *SHARES, digits=6)


@query("""
    SELECT round(count(*) FILTER (event_type <> 'error') / count(*), 6) AS completeness,
           round(count(*) FILTER (event_type NOT IN ('error', 'view', 'signup')) / count(*), 6)
             AS validity
    FROM events
""")
def quality_of_domain(spark, sf_dir):
    """Errors have no number, views an impossible date and signups an unknown element."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    events = table(spark, sf_dir, "events").select(
        F.when(kind == "error", "NaN").otherwise(F.col("value").cast("string")).alias("value"),
        F.when(kind == "view", "2024-02-31").otherwise(day).alias("date"),
        F.when(kind != "signup", kind).alias("element"),
    )
    known = ["click", "error", "purchase", "view"]
    return rounded(daily_quality(events, known), *SHARES, digits=6)


@query("""
    SELECT round(0.5::DOUBLE * count(*) FILTER (l_tax > 0) / count(*)
                 + 0.5::DOUBLE * count(*) FILTER (l_tax BETWEEN 0.02 AND 0.06) / count(*), 6)
             AS score
    FROM lineitem
""")
def quality_score(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    shares = range_quality(lines, "l_tax", 0.02, 0.06)
    return rounded(shares.select(score().alias("score")), "score", digits=6)


def scores(spark, sf_dir):
    """Scores of four datasets shaped from the tables, before and after cleaning."""
    wide = shapes.wide_months(spark, sf_dir)
    # Scaled so that part of the values is a plausible anomaly.
    scaled = {m: (number(m) / 50000.0).cast("string") for m in MONTH_NAMES}
    wide = wide.withColumns({m: F.coalesce(v, F.lit(MISSING_MARK)) for m, v in scaled.items()})
    sheet = shapes.sheet(spark, sf_dir)
    cells = shapes.grid(spark, sf_dir).withColumns(
        {
            "value": F.when(F.col("value") >= 2000000, F.col("value")).otherwise(float("nan")),
            "source_file": F.lit("cells.nc"),
        }
    )
    # Stored once, as the cleaned layer would, because both layers' scores read it.
    decoded = decode_daily_lines(shapes.daily_lines(spark, sf_dir))
    root = shared_folder(spark, "scores")
    daily = spark.read.parquet(write_layer(decoded, root, DAILY_TABLE))
    raw = {
        "nasa": missing_marks_to_null(wide, MONTH_NAMES),
        "gcb": sheet,
        "era5": cells,
        "noaa": daily,
    }
    silver = {
        "nasa": clean_anomalies(wide, ordered=False),
        "gcb": clean_carbon(sheet, ordered=False),
        "era5": clean_grid(cells, ordered=False),
        "noaa": daily,
    }
    return quality_scores(raw, silver, elements=["TMAX", "TMIN"])


SCORES_SQL = f"""
    WITH {WIDE_LONG_SQL}, {DAILY_SQL},
    nasa AS (
        SELECT 0.5 * count(v) / count(*) + 0.5 * count(*) FILTER (v / 50000.0 <= 5) / count(*) AS s
        FROM cells
    ),
    era5_raw AS (SELECT count(*) FILTER (value >= 2000000) / count(*) AS s FROM ({GRID_SQL})),
    era5_silver AS (
        SELECT count(v) / count(*) AS s
        FROM (SELECT avg(CASE WHEN value >= 2000000 THEN value END) AS v
              FROM ({GRID_SQL}) GROUP BY time, variable, units)
    ),
    noaa AS (
        SELECT 0.5 + 0.5 * count(*) FILTER (element IN ('TMAX', 'TMIN')) / count(*) AS s FROM kept
    ),
    score_rows AS (
        SELECT 'nasa' AS dataset, s AS raw_score, s AS silver_score FROM nasa
        UNION ALL SELECT 'gcb', 0.0, 1.0
        UNION ALL SELECT 'era5', (SELECT s FROM era5_raw), (SELECT s FROM era5_silver)
        UNION ALL SELECT 'noaa', s, s FROM noaa
    ),
    all_scores AS (
        SELECT dataset, raw_score::DOUBLE AS raw_score, silver_score::DOUBLE AS silver_score
        FROM score_rows
        UNION ALL SELECT 'overall', avg(raw_score), avg(silver_score) FROM score_rows
    )
"""


@query(f"""
    {SCORES_SQL}
    SELECT dataset, round(raw_score, 6) AS raw_score, round(silver_score, 6) AS silver_score
    FROM all_scores
""")
def quality_overall(spark, sf_dir):
    return rounded(score_table(scores(spark, sf_dir)), "raw_score", "silver_score", digits=6)


@query("""
    SELECT round(count(*) FILTER (l_quantity > 5) / count(*), 6) AS completeness,
           round(count(*) FILTER (l_quantity BETWEEN 10 AND 40) / count(*), 6) AS validity,
           0::BIGINT AS counted_again
    FROM lineitem
""")
def quality_after_added_files(spark, sf_dir):
    """Quantities in a folder that got its returned items later: counts of the earlier files are kept."""
    root = shared_folder(spark, "states")
    items = table(spark, sf_dir, "lineitem")
    quantity = F.when(F.col("l_quantity") > 5, F.col("l_quantity").cast("double")).alias("quantity")
    returned = F.col("l_returnflag") == "R"
    path, counts = f"{root}/items", lambda df: range_counts("quantity", 10.0, 40.0)
    items.where(~returned).select(quantity).write.parquet(path)
    first = refresh_states(spark, path, f"{root}/states", "items", counts).select("path").collect()
    items.where(returned).select(quantity).write.mode("append").parquet(path)
    states = refresh_states(spark, path, f"{root}/states", "items", counts)
    again = F.count_if(F.col("path").isin([row["path"] for row in first]) & (F.col("run") > 1))
    result = shares_of_states(states).withColumn("counted_again", states.agg(again).scalar())
    return rounded(result, *SHARES, digits=6)
