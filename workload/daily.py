"""Fixed-width station lists and daily records."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.text import between_positions
from strata.operators.select import (
    Box,
    attach,
    in_box,
    keep_missing,
    last_row_per_key,
    small_side,
)
from strata.operators.slots import count_slots, decode_daily_lines
from strata.plans.cleaned import clean_daily, prune_lines, run_daily, select_stations
from strata.plans.flat import flat_daily as flat_daily_table
from strata.plans.landing import land_raw, landed_lines
from strata.session import shared_folder
from strata.sources.files import preferred_files
from strata.sources.fixed_width import inventory_stations, read_stations
from strata.sources.lines import POSITION, read_lines
from workload import shapes
from workload.registry import query
from workload.shapes import CUSTOMER_STATIONS, DAILY_SQL, SUPPLIER_STATIONS, station_sql, table

# Fixed value: how many stations the published selection takes.
FIRST_STATIONS = 200
PREFIX_LENGTH = 9


def _lines(spark, sf_dir, source, columns):
    key, name, nation, prefix = columns
    return shapes.station_lines(table(spark, sf_dir, source), key, name, nation, prefix)


def _selected_sql(source: str, columns: tuple, balance: str, limit: str = "") -> str:
    return f"""
        SELECT s.station_id, s.lat, s.lon, s.elevation, s.name
        FROM ({station_sql(source, *columns)}) s JOIN {source} t ON t.{columns[0]} = s.k
        WHERE lat BETWEEN -11 AND 28 AND lon BETWEEN 90 AND 142 AND {balance} >= 0
        {limit}
    """


@query(f"""
    SELECT station_id, lat, lon, elevation, name
    FROM ({station_sql('customer', *CUSTOMER_STATIONS)})
""")
def fixed_width_stations(spark, sf_dir):
    return read_stations(_lines(spark, sf_dir, "customer", CUSTOMER_STATIONS))


@query("""
    SELECT DISTINCT 'CU' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS station_id
    FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def inventory_ids(spark, sf_dir):
    """One inventory line per order, its element by priority."""
    element = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "TMIN")
        .when(F.col("o_orderpriority") == "2-HIGH", "PRCP")
        .otherwise("SNOW")
    )
    line = F.concat(
        F.lit("CU"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
        F.lit(" " * 20),
        element,
        F.lit(" 1995 2001"),
    )
    return inventory_stations(table(spark, sf_dir, "orders").select(line.alias("value")))


@query(f"""
    SELECT station_id, lat, lon FROM ({station_sql('customer', *CUSTOMER_STATIONS)})
    WHERE lat BETWEEN 0 AND 10 AND lon BETWEEN 90 AND 100
""")
def stations_in_box(spark, sf_dir):
    stations = read_stations(_lines(spark, sf_dir, "customer", CUSTOMER_STATIONS))
    return in_box(stations, Box(0.0, 10.0, 90.0, 100.0)).select("station_id", "lat", "lon")


@query(_selected_sql("customer", CUSTOMER_STATIONS, "c_acctbal", f"ORDER BY s.k LIMIT {FIRST_STATIONS}"))
def bbox_semi_topn(spark, sf_dir):
    """The first 200 stations in file order that are in the box and in the inventory."""
    customers = table(spark, sf_dir, "customer")
    inventory = shapes.inventory_lines(customers, "c_custkey", "c_acctbal", "CU")
    lines = _lines(spark, sf_dir, "customer", CUSTOMER_STATIONS)
    return select_stations(lines, inventory, max_stations=FIRST_STATIONS)


@query(f"""
    WITH {DAILY_SQL}
    SELECT station_id, date, element, value, CASE WHEN trace THEN 'T' END AS mflag,
           CAST(NULL AS VARCHAR) AS qflag, 'S' AS sflag
    FROM kept
""")
def fixed_width_daily(spark, sf_dir):
    return decode_daily_lines(shapes.daily_lines(spark, sf_dir))


@query(f"""
    WITH {DAILY_SQL},
    lines AS (
        SELECT DISTINCT station_id, element, date_trunc('month', date) AS m FROM daily
    ),
    short AS (SELECT count(*) AS n FROM supplier),
    wanted AS (
        SELECT count(*) AS n, count(*) FILTER (month(m) = 2) AS february
        FROM lines WHERE element <> 'SNOW'
    ),
    slots AS (
        SELECT count(*) AS n, count(*) FILTER (missing) AS missing,
               count(*) FILTER (flagged AND NOT missing) AS flagged
        FROM daily WHERE element <> 'SNOW'
    )
    SELECT (SELECT count(*) FROM lines) + short.n AS lines, short.n AS short_lines,
           (SELECT count(*) FROM lines WHERE element = 'SNOW') AS other_lines,
           slots.n - missing - flagged AS kept_slots,
           wanted.n * 31 - slots.n - february AS blank_slots, missing AS missing_slots,
           flagged AS flagged_slots, february AS impossible_day_slots,
           0::BIGINT AS bad_month_slots, 0::BIGINT AS malformed_slots
    FROM short, wanted, slots
""")
def daily_slot_counts(spark, sf_dir):
    return count_slots(shapes.daily_lines(spark, sf_dir))


STATION_DAILY_SQL = f"""
    WITH {DAILY_SQL},
    selected AS ({_selected_sql('supplier', SUPPLIER_STATIONS, 's_acctbal')})
    SELECT k.station_id, k.date, k.element, k.value, s.lat, s.lon, s.elevation, s.name,
           CASE WHEN k.trace THEN 'T' END AS mflag, CAST(NULL AS VARCHAR) AS qflag, 'S' AS sflag
    FROM kept k JOIN selected s ON s.station_id = k.station_id
"""


def _selected_suppliers(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    return select_stations(
        _lines(spark, sf_dir, "supplier", SUPPLIER_STATIONS),
        shapes.inventory_lines(suppliers, "s_suppkey", "s_acctbal", "SU"),
    )


@query(STATION_DAILY_SQL)
def station_daily(spark, sf_dir):
    """Selected stations, their daily lines decoded, attributes attached."""
    stations = small_side(_selected_suppliers(spark, sf_dir))
    return clean_daily(shapes.daily_lines(spark, sf_dir), stations)


@query(STATION_DAILY_SQL)
def station_daily_from_files(spark, sf_dir):
    """The same from text files. Lines lie in one folder per group of stations, and only the
    folders of selected stations are read."""
    root = shared_folder(spark, "stations")
    suppliers = table(spark, sf_dir, "supplier")
    station_lines = _lines(spark, sf_dir, "supplier", SUPPLIER_STATIONS)
    station_lines.orderBy("row_id").select("value").write.text(f"{root}/stations")
    inventory = shapes.inventory_lines(suppliers, "s_suppkey", "s_acctbal", "SU")
    inventory.write.text(f"{root}/inventory")
    prefix = F.substring("file_stem", 1, PREFIX_LENGTH).alias("prefix")
    daily = shapes.encoded_daily_lines(spark, sf_dir).select("value", prefix)
    daily.write.partitionBy("prefix").text(f"{root}/daily")
    stations = select_stations(
        read_lines(spark, f"{root}/stations", position=True),
        read_lines(spark, f"{root}/inventory"),
    )
    lines = spark.read.schema("value string, prefix string").text(f"{root}/daily")
    lines = prune_lines(lines, stations)
    lines = lines.withColumn("file_stem", between_positions("value", 0, 11))
    return clean_daily(lines, small_side(stations))


# One file per supplier, named after the supplier twice as far on, whose lines keep their own id. Of
# seven suppliers one has no file, one has a file in both folders and two in the second one only.
FILE_OF = "k // 2 * 2 + (1 - k % 2)"
JOB_SQL = f"""
    {STATION_DAILY_SQL.split('SELECT k.station_id')[0].rstrip()},
    files AS (
        SELECT 'SU' || lpad(CAST({FILE_OF} AS VARCHAR), 9, '0') AS stem,
               'SU' || lpad(CAST(k AS VARCHAR), 9, '0') AS station_id
        FROM (SELECT s_suppkey AS k FROM supplier) WHERE k % 7 <> 0
    )
"""


def _station_job(spark, sf_dir):
    """Lists, daily files in two folders and the landed lines of the same files; the job on them."""
    root = shared_folder(spark, "station-job")
    suppliers = table(spark, sf_dir, "supplier")
    station_lines = _lines(spark, sf_dir, "supplier", SUPPLIER_STATIONS)
    station_lines.orderBy("row_id").select("value").write.text(f"{root}/stations")
    inventory = shapes.inventory_lines(suppliers, "s_suppkey", "s_acctbal", "SU")
    inventory.write.text(f"{root}/inventory")
    key = F.substring("file_stem", 3, 9).cast("long")
    named = shapes.daily_lines(spark, sf_dir).withColumn("k", key).where("k % 7 <> 0")
    stem = F.concat(F.lit("SU"), F.lpad(F.expr(FILE_OF.replace("//", "div")).cast("string"), 9, "0"))
    named = named.withColumn("stem", stem)
    shapes.write_named_files(named.where("k % 7 not in (2, 3)"), f"{root}/daily/all", ".dly")
    shapes.write_named_files(named.where("k % 7 in (2, 3)"), f"{root}/daily/all/all", ".dly")
    wrong = named.where("k % 7 = 1").withColumn("value", F.concat(F.substring("value", 1, 17), F.lit("SNOW")))
    shapes.write_named_files(wrong, f"{root}/daily/all/all", ".dly")
    folders = [f"{root}/daily/all", f"{root}/daily/all/all", f"{root}/daily/none"]
    inputs = {"daily": [(f"{root}/daily", "*.zip"), (f"{root}/daily", "*.dly")]}
    land_raw(spark, inputs, f"{root}/bronze", text_datasets=["daily"], prefix_length=PREFIX_LENGTH)
    landed = landed_lines(spark, f"{root}/bronze", "daily")
    lists = f"{root}/stations", f"{root}/inventory"
    return run_daily(spark, *lists, folders, f"{root}/silver", landed=landed)


@query(f"""
    {JOB_SQL}
    SELECT k.station_id, k.date, k.element, k.value, s.lat, s.lon, s.elevation, s.name,
           CASE WHEN k.trace THEN 'T' END AS mflag, CAST(NULL AS VARCHAR) AS qflag, 'S' AS sflag
    FROM kept k JOIN files f ON f.station_id = k.station_id JOIN selected s ON s.station_id = f.stem
""")
def station_job(spark, sf_dir):
    """The station job: attributes by the file's name, ids from the lines, the first folder first."""
    return _station_job(spark, sf_dir)[0]


@query(f"""
    {JOB_SQL}
    SELECT station_id FROM selected WHERE station_id NOT IN (SELECT stem FROM files)
""")
def stations_without_file(spark, sf_dir):
    return _station_job(spark, sf_dir)[1]


@query(f"""
    SELECT station_id, date, element, value, lat, lon, elevation, name FROM ({STATION_DAILY_SQL})
""")
def flat_daily(spark, sf_dir):
    return flat_daily_table(station_daily(spark, sf_dir))


@query("""
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
        SELECT o_custkey FROM orders
        WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 2001)
""")
def missing_sources(spark, sf_dir):
    """Customers without an urgent order in 2001."""
    urgent = table(spark, sf_dir, "orders").where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 2001)
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return keep_missing(customers, urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("""
    SELECT e.event_id, e.user_id, o.o_orderpriority AS priority, o.o_totalprice AS price
    FROM events e JOIN (
        SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority,
               arg_max(o_totalprice, o_orderkey) AS o_totalprice
        FROM orders GROUP BY o_custkey
    ) o ON o.o_custkey = e.user_id
""")
def lookup_join(spark, sf_dir):
    """Events with the attributes of their user, the last of several rows per user."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").alias("price"),
        F.lit("orders").alias("file_path"),
        F.lit(0).alias("block_start"),
        F.col("o_orderkey").alias("row_id"),
    )
    last = last_row_per_key(rows, "customer").drop(*POSITION)
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return attach(events, last, "user_id", "customer")


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS stem,
           min_by(path, (CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END, path)) AS path
    FROM (SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'root/' ELSE 'root/nested/' END
                    || o_orderkey AS path FROM orders)
    GROUP BY o_custkey
""")
def preferred_file_per_stem(spark, sf_dir):
    """One path per customer, one in the first folder before those in the nested one."""
    first = F.col("o_orderstatus") == "O"
    folder = F.when(first, "root/").otherwise("root/nested/")
    files = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("stem"),
        F.when(first, 0).otherwise(1).alias("priority"),
        F.concat(folder, F.col("o_orderkey").cast("string")).alias("path"),
    )
    return preferred_files(files)
