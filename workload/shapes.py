"""The given tables in the shapes the library reads, as DataFrames and as the same SQL.

The tables hold no NULLs, NaNs or sentinels, so the shapes put some in by value.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import MONTH_NAMES
from strata.operators.slots import MISSING_VALUE, SLOT_WIDTH
from strata.session import shared_folder
from strata.sinks import write_layer
from strata.sources.delimited import MISSING_MARK


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Means differ in their last digits with the order of summation."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


def cents(column: str) -> Column:
    """An amount in whole cents: their sums are exact, so rounded means never hang on a tie."""
    return F.round(F.col(column) * 100, 0)


# Orders as monthly anomalies: pending orders have no value.
ANOMALIES_SQL = """
    SELECT CAST(year(o_orderdate) AS INT) AS year, strftime(o_orderdate, '%m') AS month,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
           CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice * 100) END AS anomaly
    FROM orders
"""


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "MM").alias("month"),
        F.trunc("o_orderdate", "MM").alias("date"),
        F.when(F.col("o_orderstatus") != "P", cents("o_totalprice")).alias("anomaly"),
    )


# Line items as grid cells: one variable per return flag, one of them without units.
GRID_SQL = """
    SELECT l_shipdate AS time,
           CASE l_returnflag WHEN 'A' THEN 'd2m' WHEN 'N' THEN 'tp' ELSE 't2m' END AS variable,
           CASE WHEN l_returnflag <> 'N' THEN 'K' END AS units,
           round(l_extendedprice * 100) AS value
    FROM lineitem
"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("time"),
        F.when(flag == "A", "d2m").when(flag == "N", "tp").otherwise("t2m").alias("variable"),
        F.when(flag != "N", "K").alias("units"),
        cents("l_extendedprice").alias("value"),
    )


# Line items as yearly metrics in long form.
METRICS = {
    "l_quantity": "land_use",
    "l_extendedprice": "fossil_emissions",
    "l_discount": "ocean_sink",
    "l_tax": "total_budget",
}
CARBON_SQL = " UNION ALL ".join(
    f"SELECT CAST(year(l_shipdate) AS INT) AS year, '{metric}' AS metric, {column} AS value "
    "FROM lineitem"
    for column, metric in METRICS.items()
)


def carbon(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("year"),
        *[F.col(column).alias(metric) for column, metric in METRICS.items()],
    )
    return wide.unpivot(["year"], list(METRICS.values()), "metric", "value")


# One row per customer and year with the largest order of each month as text.
WIDE_LONG_SQL = """
    monthly AS (
        SELECT o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
               max(o_totalprice) AS v
        FROM orders GROUP BY ALL
    ),
    cells AS (
        SELECT k.o_custkey, k.y, n.m, c.v
        FROM (SELECT DISTINCT o_custkey, y FROM monthly) k
        CROSS JOIN (SELECT unnest(range(1, 13)) AS m) n
        LEFT JOIN monthly c ON c.o_custkey = k.o_custkey AND c.y = k.y AND c.m = n.m
    )
"""


def wide_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.month("o_orderdate")
    cells = [
        F.coalesce(
            F.max(F.when(month == index, F.col("o_totalprice"))).cast("string"),
            F.lit(MISSING_MARK),
        ).alias(name)
        for index, name in enumerate(MONTH_NAMES, 1)
    ]
    keys = ["o_custkey", F.year("o_orderdate").cast("string").alias("Year")]
    return table(spark, sf_dir, "orders").groupBy(*keys).agg(*cells).drop("o_custkey")


# Orders as a sheet: one row per customer and year, odd column names, bad years, empty column.
SHEET_LONG_SQL = """
    sheet AS (
        SELECT o_custkey, year(o_orderdate) AS y, o_orderpriority AS p, max(o_totalprice) AS v
        FROM orders GROUP BY ALL
    )
"""
SHEET_METRICS = {
    "1-URGENT": "Fossil fuel\n(urgent)",
    "2-HIGH": "  Land-use change / high ",
    "3-MEDIUM": "ocean sink",
    "4-NOT SPECIFIED": "Budget: imbalance?",
    "5-LOW": "Low",
}


def sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    # Customers with a key below 10 get a year out of range, the next ten a text instead.
    shown = (
        F.when(F.col("o_custkey") < 10, (year + 1000).cast("string"))
        .when(F.col("o_custkey") < 20, F.lit("total"))
        .otherwise(year.cast("string"))
    )
    price = F.col("o_totalprice")
    metrics = [
        F.max(F.when(F.col("o_orderpriority") == priority, price)).cast("string").alias(name)
        for priority, name in SHEET_METRICS.items()
    ]
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", shown.alias("Data Year"))
    return rows.agg(*metrics, F.first(F.lit(None).cast("string")).alias("Notes")).drop("o_custkey")


# Fixed-width station list and inventory from suppliers or customers.
def station_lines(source: DataFrame, key: str, name: str, nation: str, prefix: str) -> DataFrame:
    """Station lines with their position; some stations have a blank elevation."""
    lat = F.pmod(F.col(key), F.lit(50)) - 15
    lon = F.pmod(F.col(key) * 7, F.lit(70)) + 80
    elevation = F.when(F.col(nation) == 0, F.lit(" " * 6)).otherwise(
        F.format_string("%6.1f", F.col(nation) * 10.0)
    )
    line = F.concat(
        F.lit(prefix),
        F.lpad(F.col(key).cast("string"), 9, "0"),
        F.format_string(" %8.4f %9.4f ", lat.cast("double"), lon.cast("double")),
        elevation,
        F.lit(" " * 4),
        F.col(name),
    )
    return source.select(
        line.alias("value"),
        F.lit("stations.txt").alias("file_path"),
        F.lit(0).alias("block_start"),
        F.col(key).alias("row_id"),
    )


def station_sql(source: str, key: str, name: str, nation: str, prefix: str) -> str:
    return f"""
        SELECT '{prefix}' || lpad(CAST({key} AS VARCHAR), 9, '0') AS station_id,
               CAST({key} % 50 - 15 AS DOUBLE) AS lat,
               CAST({key} * 7 % 70 + 80 AS DOUBLE) AS lon,
               CAST({nation} * 10 AS DOUBLE) AS elevation, {name} AS name, {key} AS k
        FROM {source}
    """


def inventory_lines(source: DataFrame, key: str, balance: str, prefix: str) -> DataFrame:
    """Inventory lines; holders of a debt report an element nobody wants."""
    element = F.when(F.col(balance) < 0, "SNOW").otherwise("TMAX")
    line = F.concat(
        F.lit(prefix),
        F.lpad(F.col(key).cast("string"), 9, "0"),
        F.lit(" " * 20),
        element,
        F.lit(" 1995 2001"),
    )
    return source.select(line.alias("value"))


SUPPLIER_STATIONS = ("s_suppkey", "s_name", "s_nationkey", "SU")
CUSTOMER_STATIONS = ("c_custkey", "c_name", "c_nationkey", "CU")

# Line items as daily values per supplier: tenths of the quantity less 20, with missing and
# flagged days, and a value on the 30th of each February.
DAILY_SQL = """
    daily AS (
        SELECT 'SU' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS station_id,
               CASE WHEN l_returnflag = 'A' THEN 'TMAX' WHEN l_returnflag = 'R' THEN 'TMIN'
                    WHEN l_linestatus = 'O' THEN 'PRCP' ELSE 'SNOW' END AS element,
               CAST(l_shipdate AS DATE) AS date,
               max(l_quantity) - 20 AS value,
               max(l_discount) >= 0.1 AS missing, max(l_tax) >= 0.08 AS flagged,
               min(l_tax) = 0.0 AS trace
        FROM lineitem GROUP BY ALL
    ),
    kept AS (
        SELECT * FROM daily WHERE element <> 'SNOW' AND NOT missing AND NOT flagged
    )
"""


def daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily lines as a stored table, as the raw layer holds them.

    Decoding straight from the expressions below would evaluate them once per use of a line.
    """
    root = shared_folder(spark, "daily-lines")
    return spark.read.parquet(write_layer(encoded_daily_lines(spark, sf_dir), root, "lines"))


def encoded_daily_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per supplier, element and month, and one short line per supplier."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    element = (
        F.when(flag == "A", "TMAX")
        .when(flag == "R", "TMIN")
        .when(status == "O", "PRCP")
        .otherwise("SNOW")
    )
    day = F.to_date("l_shipdate")
    month = ["l_suppkey", "element", "month"]
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        element.alias("element"),
        F.trunc(day, "MM").alias("month"),
        F.dayofmonth(day).alias("day"),
        "l_quantity",
        "l_discount",
        "l_tax",
    )
    # Rows are dealt by month once, which serves the days of a month as well as the month.
    days = (
        items.repartition(*month)
        .groupBy(*month, "day")
        .agg(
            F.max("l_quantity").alias("quantity"),
            F.max("l_discount").alias("discount"),
            F.max("l_tax").alias("tax"),
            F.min("l_tax").alias("least_tax"),
        )
    )
    tenths = ((F.col("quantity") - 20) * 10).cast("int")
    value = F.when(F.col("discount") >= 0.1, F.lit(MISSING_VALUE)).otherwise(tenths)
    slot = F.concat(
        F.lpad(value.cast("string"), 5, " "),
        F.when(F.col("least_tax") == 0, "T").otherwise(" "),
        F.when(F.col("tax") >= 0.08, "X").otherwise(" "),
        F.lit("S"),
    )
    # A month has at most 31 days, so the list below is bounded.
    months = days.groupBy(*month).agg(
        F.array_sort(F.collect_list(F.struct("day", slot.alias("slot")))).alias("slots")
    )

    def at_day(text: Column, day: Column, slot: Column) -> Column:
        return F.concat(F.rpad(text, (day - 1) * SLOT_WIDTH, " "), slot)

    text = F.aggregate("slots", F.lit(""), lambda text, s: at_day(text, s["day"], s["slot"]))
    february = F.month("month") == 2
    text = F.when(february, at_day(text, F.lit(30), F.lit("  100   "))).otherwise(text)

    def station(key: str) -> Column:
        return F.concat(F.lit("SU"), F.lpad(F.col(key).cast("string"), 9, "0"))

    header = F.concat(station("l_suppkey"), F.date_format("month", "yyyyMM"), "element")
    full = months.select(
        F.rtrim(F.concat(header, text)).alias("value"), station("l_suppkey").alias("file_stem")
    )
    ids = table(spark, sf_dir, "supplier").select(station("s_suppkey").alias("value"))
    return full.unionByName(ids.withColumn("file_stem", F.col("value")))


def write_named_files(lines: DataFrame, root: str, suffix: str, *, ordered: bool = False) -> None:
    """``value`` of the rows with one ``stem`` as the file ``root/stem + suffix``.

    Names are escaped as those of Spark's partition folders are. In a folder that is a path of its own, the tasks
    write the files under their names, and nothing is done per file by the driver. In another store, which only
    Spark reaches, each stem is written as a folder with one file, which is then moved; only for few files.
    ``ordered`` rows are dealt and sorted by stem already.
    """
    spark = lines.sparkSession
    kept = lines.select("stem", "value")
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(root))
    if system.getScheme() == "file":
        name = F.coalesce(F.nullif(F.col("stem").cast("string"), F.lit("")), F.lit(NO_STEM))
        kept = kept.select(name.alias("stem"), F.col("value").cast("string"))
        if not ordered:
            # A given number of parts: adaptive execution would merge parts of few bytes and many files.
            parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
            kept = kept.repartition(parts, "stem").sortWithinPartitions("stem")
        write = _file_writer(path(root).toUri().getPath(), suffix)
        kept.mapInArrow(write, "files long").agg(F.sum("files")).collect()
        return
    kept = kept if ordered else kept.repartition("stem")
    kept.write.partitionBy("stem").text(f"{root}-by-stem")
    for found in system.globStatus(path(f"{root}-by-stem/stem=*/part-*")):
        stem = found.getPath().getParent().getName().removeprefix("stem=")
        system.rename(found.getPath(), path(f"{root}/{stem}{suffix}"))
    system.delete(path(f"{root}-by-stem"), True)


# Spark's folder name for rows without a value of the partition column, and what it escapes in others.
NO_STEM = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]")


def _file_writer(folder: str, suffix: str) -> Callable[[Iterator], Iterator]:
    """A task's function that writes sorted ``(stem, value)`` rows as files, with one of them open at a time.

    A file gets its name when it is whole, so that a task that is run again replaces it.
    """

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        stem, file, draft, files = None, None, f"{folder}/.{uuid.uuid4().hex}.part", 0

        def close() -> None:
            file.close()
            escaped = _ESCAPED.sub(lambda found: f"%{ord(found.group()):02X}", stem)
            os.replace(draft, f"{folder}/{escaped}{suffix}")

        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            start = 0
            for end, name in zip(runs.run_ends.to_pylist(), runs.values.to_pylist()):
                if name != stem:
                    if file:
                        close()
                    stem, file, files = name, open(draft, "wb"), files + 1
                values = batch.column(1).slice(start, end - start).to_pylist()
                file.write("".join([(value or "") + "\n" for value in values]).encode())
                start = end
        if file:
            close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return write
