"""Wide to long, column names and delimited text."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.dates import MONTH_LABELS, MONTH_NAMES, month_number
from strata.functions.text import base_name, contains_any_case, file_stem, snake_case, zero_padded
from strata.operators.reshape import (
    drop_empty_columns,
    months_to_rows,
    sheet_to_rows,
    snake_case_columns,
    unpivot_columns,
)
from strata.operators.select import choose_match, with_place
from strata.plans.cleaned import choose_sheet, clean_anomalies, run_anomalies, run_carbon
from strata.session import shared_folder
from strata.sources.delimited import missing_marks_to_null, read_anomaly_csv, read_sheet_csv
from strata.sources.tables import with_source_file
from workload import shapes
from workload.registry import query
from workload.shapes import SHEET_LONG_SQL, WIDE_LONG_SQL, table

LONG_MONTHS_SQL = f"""
    WITH {WIDE_LONG_SQL}
    SELECT CAST(y AS INT) AS year, lpad(CAST(m AS VARCHAR), 2, '0') AS month,
           make_date(y, m, 1) AS date, v AS anomaly
    FROM cells
"""
_SHEET_NAMES = {
    "1-URGENT": "fossil_fuel_urgent",
    "2-HIGH": "land_use_change_high",
    "3-MEDIUM": "ocean_sink",
    "4-NOT SPECIFIED": "budget_imbalance",
    "5-LOW": "low",
}
_CASES = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in _SHEET_NAMES.items())
SHEET_SQL = f"""
    WITH {SHEET_LONG_SQL}
    SELECT CAST(y AS INT) AS year, CASE p {_CASES} END AS metric, v AS value
    FROM sheet WHERE o_custkey >= 20
"""


@query("""
    SELECT l_orderkey, metric, nullif(value, 0.0) AS value
    FROM (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
    UNPIVOT (value FOR metric IN (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def unpivot_fixed(spark, sf_dir):
    """Zero stands for a missing value here and becomes NULL; NULL rows stay."""
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {name: F.nullif(F.col(name), F.lit(0.0)) for name in measures}
    )
    return unpivot_columns(lines, ["l_orderkey"], measures, "metric", "value")


@query(SHEET_SQL)
def unpivot_dynamic_dropnull(spark, sf_dir):
    return sheet_to_rows(shapes.sheet(spark, sf_dir))


@query(SHEET_SQL)
def carbon_sheet_job(spark, sf_dir):
    """The sheet exported as CSV files, cleaned and stored; one name has a line break in it."""
    sheet = shapes.sheet(spark, sf_dir)
    root = shared_folder(spark, "sheet")
    sheet.write.option("header", True).csv(f"{root}/in")
    return run_carbon(spark, f"{root}/in", f"{root}/silver")


@query(LONG_MONTHS_SQL)
def wide_month_to_long(spark, sf_dir):
    return clean_anomalies(shapes.wide_months(spark, sf_dir), ordered=False)


@query(LONG_MONTHS_SQL)
def anomaly_csv_job(spark, sf_dir):
    """The wide months as CSV files, each with a header line, cleaned and stored."""
    root = shared_folder(spark, "anomalies")
    shapes.wide_months(spark, sf_dir).write.option("header", True).csv(f"{root}/in")
    return run_anomalies(spark, f"{root}/in", f"{root}/silver")


@query(f"""
    WITH {WIDE_LONG_SQL}
    SELECT CAST(y AS VARCHAR) AS year, %s
    FROM cells GROUP BY o_custkey, y
""" % ", ".join(f"max(v) FILTER (m = {m}) AS {n.lower()}" for m, n in enumerate(MONTH_NAMES, 1)))
def raw_wide_csv(spark, sf_dir):
    """The raw wide table as read from CSV, missing marks as NULL."""
    root = shared_folder(spark, "raw-wide")
    shapes.wide_months(spark, sf_dir).write.option("header", True).csv(f"{root}/in")
    wide = missing_marks_to_null(read_anomaly_csv(spark, f"{root}/in"), MONTH_NAMES)
    months = [F.col(name).cast("double").alias(name.lower()) for name in MONTH_NAMES]
    return wide.select(F.col("Year").alias("year"), *months)


@query("""
    SELECT o_orderstatus AS status, o_orderkey AS k FROM orders WHERE o_orderkey >= 8
    UNION ALL SELECT 'Land-Ocean: again', o_orderkey FROM orders WHERE o_orderkey < 8
    UNION ALL SELECT 'Status', 0 FROM orders WHERE o_orderkey = 8
    UNION ALL SELECT 'Status', -1 FROM orders WHERE o_orderkey = 8
""")
def preamble_by_place(spark, sf_dir):
    """Two files, one with a preamble. Blank lines, a later line that opens like the preamble and
    rows with the words of the header stand between the data."""
    root = shared_folder(spark, "preamble")
    key = F.col("o_orderkey")
    line = F.when(key < 8, F.concat(F.lit("Land-Ocean: again,"), key.cast("string"))).otherwise(
        F.concat("o_orderstatus", F.lit(","), key.cast("string"))
    )
    more = F.when(key == 8, F.array(F.lit("Status,0"), F.lit("Status,-1"), F.lit(" \t"))).otherwise(F.array())
    lines = table(spark, sf_dir, "orders").select(
        (key % 2).cast("string").alias("stem"), key, F.explode(F.concat(F.array(line), more)).alias("value")
    )
    heads = [("0", -3, "Land-Ocean: means"), ("0", -2, ""), ("0", -1, "Status,Key"), ("1", -1, "Status,Key")]
    headed = lines.unionByName(spark.createDataFrame(heads, "stem string, o_orderkey bigint, value string"))
    ordered = headed.repartition("stem").sortWithinPartitions("stem", "o_orderkey")
    shapes.write_named_files(ordered, f"{root}/in", ".csv", ordered=True)
    rows = read_anomaly_csv(spark, f"{root}/in")
    return rows.select(F.col("Status").alias("status"), F.col("Key").cast("bigint").alias("k"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def empty_columns_dropped(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        F.nullif("c_nationkey", "c_nationkey").alias("empty number"),
        "c_acctbal",
        F.nullif("c_mktsegment", "c_mktsegment").alias("empty.text"),
    )
    return drop_empty_columns(customers)


@query("""
    SELECT page_id, coalesce(nullif(lower(trim(regexp_replace(url, '[^0-9a-zA-Z]+', '_', 'g'),
           '_')), ''), 'col') AS url_name,
           coalesce(nullif(lower(trim(regexp_replace(html, '[^0-9a-zA-Z]+', '_', 'g'), '_')), ''),
           'col') AS html_name
    FROM pages
""")
def snake_case_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", snake_case("url").alias("url_name"), snake_case("html").alias("html_name")
    )


@query("""
    SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size_cm, p_type AS col FROM part
""")
def snake_case_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias(" Part key"),
        F.col("p_name").alias("part\nNAME"),
        F.col("p_size").alias("__Size (cm)"),
        F.col("p_type").alias("%"),
    )
    return snake_case_columns(part)


@query(f"""
    WITH {WIDE_LONG_SQL}
    SELECT CAST(y AS INT) AS year, CAST(m AS INT) AS month_number, count(v) AS present,
           count(*) AS months
    FROM cells GROUP BY 1, 2
""")
def month_names_to_numbers(spark, sf_dir):
    wide = shapes.wide_months(spark, sf_dir)
    names = [name for name in wide.columns if name != "Year"]
    long = unpivot_columns(wide, ["Year"], names, "month", "text")
    keys = [F.col("Year").cast("int").alias("year"), month_number("month").alias("month_number")]
    return long.groupBy(*keys).agg(
        F.count_if(F.col("text") != "***").alias("present"), F.count(F.lit(1)).alias("months")
    )


@query(f"""
    WITH {WIDE_LONG_SQL}
    SELECT lpad(CAST(m AS VARCHAR), 2, '0') AS month, count(v) AS present FROM cells GROUP BY 1
""")
def padded_month_labels(spark, sf_dir):
    rows = months_to_rows(shapes.wide_months(spark, sf_dir))
    labels = rows.groupBy(zero_padded(F.col("month").cast("int"), 2).alias("month"))
    return labels.agg(F.count("anomaly").alias("present")).where(F.col("month").isin(*MONTH_LABELS))


@query("""
    SELECT 'customer.parquet' AS source_file, count(*) AS n FROM customer
    UNION ALL SELECT 'lineitem.parquet', count(*) FROM lineitem
    UNION ALL SELECT 'orders.parquet', count(*) FROM orders
""")
def rows_per_source_file(spark, sf_dir):
    named = None
    for name in ("customer", "lineitem", "orders"):
        rows = with_source_file(table(spark, sf_dir, name)).select("source_file")
        named = rows if named is None else named.unionByName(rows)
    return named.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT url, regexp_extract(url, '[^/]*$') AS base_name,
           CASE WHEN regexp_matches(regexp_extract(url, '[^/]*$'), '^.+\\.[^.]+$')
                THEN regexp_replace(regexp_extract(url, '[^/]*$'), '\\.[^.]+$', '')
                ELSE regexp_extract(url, '[^/]*$') END AS stem
    FROM (SELECT url FROM pages UNION ALL SELECT url || '.tar.gz' FROM pages)
""")
def base_names_and_stems(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url")
    urls = pages.union(pages.select(F.concat("url", F.lit(".tar.gz"))))
    return urls.select("url", base_name("url").alias("base_name"), file_stem("url").alias("stem"))


@query("""
    SELECT lang, count(*) AS n FROM documents
    WHERE contains(lower(text), 'the') GROUP BY lang
""")
def texts_containing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    found = documents.where(contains_any_case("text", "the"))
    return found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT coalesce(
        (SELECT min(url) FROM pages
         WHERE contains(lower(url), 'en') AND contains(lower(url), 'com')),
        (SELECT min(url) FROM pages)) AS sheet
""")
def sheet_choice(spark, sf_dir):
    """Preference of several words, all of which the name must contain."""
    pages = table(spark, sf_dir, "pages")
    return choose_match(pages, "url", (("en", "com"),), alias="sheet")


@query("SELECT arg_min(url, page_id) AS sheet FROM pages")
def sheet_choice_first(spark, sf_dir):
    """No name matches, so the first in position is taken."""
    sheets = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("position"), F.col("url").alias("sheet")
    )
    return choose_sheet(sheets)


@query("""
    SELECT conv_id, turn, md5(role || replace(text, ' ', chr(10)) || '"') AS said FROM conversations
""")
def sheet_with_line_breaks(spark, sf_dir):
    """Conversations exported as a sheet whose cells hold line breaks, commas and quotes, read back."""
    root = shared_folder(spark, "breaks")
    said = F.concat("role", F.replace("text", F.lit(" "), F.lit("\n")), F.lit('"'))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", said.alias("said"))
    rows.write.options(header=True, escape='"').csv(root)
    sheet = read_sheet_csv(spark, root)
    kinds = {name: F.col(name).cast(rows.schema[name].dataType) for name in ("conv_id", "turn")}
    return sheet.withColumns(kinds | {"said": F.md5("said")})


@query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority DESC, o_orderkey) AS place FROM orders
    QUALIFY place <= (SELECT count(*) // 2 FROM orders)
""")
def first_half_of_orders(spark, sf_dir):
    """The first half of the orders by priority, numbered without a task that sees all of them."""
    orders = table(spark, sf_dir, "orders")
    rank = -F.ascii("o_orderpriority")
    ranked = orders.select("o_orderkey", rank.alias("rank"))
    half = orders.agg(F.expr("count(1) div 2")).scalar()
    return with_place(ranked, ["rank", "o_orderkey"]).where(F.col("place") <= half).select("o_orderkey", "place")
