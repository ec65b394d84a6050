"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import dates, text, values
from workload.registry import query
from workload.shapes import table


@query("""
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_linenumber IN (1, 3, 4, 6) THEN NULL ELSE l_quantity END AS value
    FROM lineitem
""")
def safe_numbers(spark, sf_dir):
    """Numbers as text, with blanks, sentinels, words, NaN and Java-only spellings among them."""
    shown = F.col("l_quantity").cast("string")
    spelled = (
        F.when(F.col("l_linenumber") == 1, F.lit(" *** "))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit(" \t"), shown, F.lit("  ")))
        .when(F.col("l_linenumber") == 3, F.lit("n/a"))
        .when(F.col("l_linenumber") == 4, F.lit("NaN"))
        .when(F.col("l_linenumber") == 5, F.concat(shown, F.lit("e0")))
        .when(F.col("l_linenumber") == 6, F.concat(shown, F.lit("d")))
        .otherwise(shown)
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        values.number(values.without_sentinel(spelled, "***")).alias("value"),
    )


@query("""
    SELECT o_orderkey,
           make_date(year(o_orderdate), month(o_orderdate), 1) AS first_day,
           TRY_CAST(printf('%04d-%02d-%02d', year(o_orderdate), month(o_orderdate),
                    o_custkey % 31 + 1) AS DATE) AS any_day
    FROM orders
""")
def dates_from_parts(spark, sf_dir):
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dates.date_from_parts(year, month).alias("first_day"),
        dates.date_from_parts(year, month, F.pmod("o_custkey", F.lit(31)) + 1).alias("any_day"),
    )


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS date,
           CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS time
    FROM events
""")
def dates_from_text(spark, sf_dir):
    """Dates and times as text; errors carry text that is neither."""
    error = F.col("event_type") == "error"
    day = F.when(error, F.lit("2024-02-31")).otherwise(F.date_format("ts", " yyyy-MM-dd"))
    time = F.when(error, F.lit("noon")).otherwise(dates.second_text("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.text_to_date(day).alias("date"),
        dates.text_to_timestamp(time).cast("timestamp_ntz").alias("time"),
    )


@query("""
    SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(year(ts) AS INT) AS year,
           date_trunc('second', ts) AS second, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text
    FROM events
""")
def time_parts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.month_bucket("ts").alias("month"),
        F.year("ts").alias("year"),
        dates.to_second("ts").cast("timestamp_ntz").alias("second"),
        dates.second_text("ts").alias("second_text"),
    )


@query("""
    SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS padded,
           nullif(trim(substr(c_name, 10, 4)), '') AS part, c_custkey / 10.0::DOUBLE AS tenth
    FROM customer
""")
def text_fields(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.zero_padded("c_custkey", 9).alias("padded"),
        text.blank_to_null(text.between_positions("c_name", 9, 13)).alias("part"),
        values.scaled("c_custkey", 10.0).alias("tenth"),
    )


def _size_sql(size: str) -> str:
    bands = " ".join(
        f"WHEN {size} < 1024.0 ** {power + 1} THEN printf('%.1f{unit}', {size} / 1024.0 ** {power})"
        for power, unit in enumerate(("B", "KB", "MB", "GB", "TB"))
    )
    return f"CASE {bands} ELSE printf('%.1fPB', {size} / 1024.0 ** 5) END"


@query(f"""
    SELECT doc_id, {_size_sql('n_chars::DOUBLE')} AS size,
           {_size_sql('(n_chars::DOUBLE * n_chars * n_chars)')} AS large_size
    FROM documents
""")
def human_sizes(spark, sf_dir):
    size = F.col("n_chars").cast("double")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.human_size(size).alias("size"),
        text.human_size(size * size * size).alias("large_size"),
    )


@query("""
    SELECT o_orderkey, printf('%.4f', o_totalprice / 1000) AS price,
           CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                ELSE printf('%.2fx', o_totalprice / 1000) END AS ratio,
           printf('%.2fx', o_custkey / 8.0::DOUBLE) AS eighths
    FROM orders
""")
def formatted_numbers(spark, sf_dir):
    """Thousandths end in a decimal tie in many rows, eighths in a binary one."""
    ratio = values.ratio(
        F.col("o_totalprice"), F.when(F.col("o_orderstatus") == "P", 0).otherwise(1000)
    )
    eighths = values.ratio(F.col("o_custkey"), F.lit(8))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.four_decimals(F.col("o_totalprice") / 1000).alias("price"),
        text.ratio_text(ratio).alias("ratio"),
        text.ratio_text(eighths).alias("eighths"),
    )
