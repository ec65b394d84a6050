"""Cleaned layer: each raw format as one long table, one observation per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata import schemas
from strata.functions.dates import text_to_timestamp, to_second
from strata.functions.text import snake_name
from strata.operators.aggregate import data_variables, grid_mean, in_order, in_stable_order
from strata.operators.reshape import drop_empty_columns, months_to_rows, sheet_to_rows
from strata.operators.select import (
    STATION_BYTES,
    Box,
    attach,
    choose_match,
    first_rows,
    in_box,
    keep_known,
    keep_missing,
    last_row_per_key,
    require_rows,
    small_side,
)
from strata.operators.slots import decode_daily_lines
from strata.session import shared_folder, stored
from strata.sinks import write_layer
from strata.sources.delimited import read_anomaly_csv, read_sheet_csv
from strata.sources.files import of_files, read_selected_files, require_files, station_files
from strata.sources.fixed_width import ELEMENTS, inventory_stations, read_stations
from strata.sources.lines import POSITION, read_lines

# Where each table lies below the root of its layer.
ANOMALY_TABLE = "nasa/gistemp"
CARBON_TABLE = "gcb/global_carbon_budget"
GRID_TABLE = "copernicus/era5_asean"
DAILY_TABLE = "noaa/ghcnd_daily"

# Fixed value: the sheet whose name holds all of these words is the one to read.
SHEET_WORDS = (("global", "budget"),)


def clean_anomalies(wide: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Wide text table of years and months to the long anomaly table."""
    rows = months_to_rows(wide)
    rows = in_stable_order(rows, "date") if ordered else rows
    return schemas.conform(rows, schemas.ANOMALY)


def clean_carbon(sheet: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Sheet with any metric columns to the long carbon table."""
    # Cells without a value are dropped anyway; an empty column matters only where the first one is
    # taken for the year because no name says so.
    named = any("year" in snake_name(name) for name in sheet.columns)
    rows = sheet_to_rows(sheet if named else drop_empty_columns(sheet))
    rows = in_stable_order(rows, "year", "metric") if ordered else rows
    return schemas.conform(rows, schemas.CARBON)


def clean_grid(cells: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Grid cells ``(time, variable, units, source_file, value)`` to one mean per time step.

    Times may be text; text that is no time becomes NULL.
    """
    is_text = isinstance(cells.schema["time"].dataType, StringType)
    time = text_to_timestamp("time") if is_text else F.col("time").cast("timestamp")
    steps = data_variables(cells).withColumn("time", to_second(time))
    means = grid_mean(steps, ["time", "variable", "units", "source_file"])
    means = schemas.conform(means, schemas.GRID)
    return in_order(means, "time", "variable", "source_file") if ordered else means


def choose_sheet(sheets: DataFrame) -> DataFrame:
    """One row with the sheet to read, from ``(position, sheet)``: by name, else the first."""
    return choose_match(sheets, "sheet", SHEET_WORDS, position="position", alias="sheet")


def select_stations(
    station_lines: DataFrame,
    inventory_lines: DataFrame,
    *,
    box: Box = Box(),
    max_stations: int | None = None,
    elements: Sequence[str] = ELEMENTS,
) -> DataFrame:
    """Stations in the box with a wanted element; with ``max_stations`` the first in file order."""
    stations = in_box(read_stations(station_lines, keep=POSITION), box)
    eligible = inventory_stations(inventory_lines, elements)
    known = keep_known(stations, eligible, "station_id")
    if max_stations is not None:
        known = first_rows(known, max_stations)
    return last_row_per_key(known, "station_id").drop(*POSITION)


def prune_lines(lines: DataFrame, stations: DataFrame, prefix: str = "prefix") -> DataFrame:
    """Lines in folders named after the first characters of a station id, for ``stations`` only.

    ``prefix`` is the folder column; its names tell how many characters they have. Spark works out
    the wanted values first and lists and reads only their folders.
    """
    widest = lines.select(F.length(prefix).alias("n")).first()
    length = widest["n"] if widest else 0
    wanted = stations.select(F.substring("station_id", 1, length).alias(prefix)).distinct()
    return lines.join(small_side(wanted), prefix, "left_semi")


def clean_daily(
    lines: DataFrame,
    stations: DataFrame,
    *,
    elements: Sequence[str] = ELEMENTS,
    strict: bool = False,
) -> DataFrame:
    """Daily lines with ``file_stem`` to observations with the attributes of their station.

    The attributes are those of the station the file is named after, the id is the line's own.
    They are attached to lines, not to the up to 31 observations of each line.
    """
    placed = attach(lines, stations, "file_stem", "station_id")
    keep = ["lat", "lon", "elevation", "name"]
    rows = decode_daily_lines(placed, elements, keep=keep, strict=strict)
    return schemas.conform(rows, schemas.STATION_DAILY)


def run_anomalies(spark: SparkSession, paths: str | Sequence[str], root: str) -> DataFrame:
    rows = clean_anomalies(read_anomaly_csv(spark, paths))
    return spark.read.parquet(write_layer(rows, root, ANOMALY_TABLE))


def run_carbon(
    spark: SparkSession, paths: str | Sequence[str], root: str, *, header_row: int = 0
) -> DataFrame:
    rows = clean_carbon(read_sheet_csv(spark, paths, header_row=header_row))
    return spark.read.parquet(write_layer(rows, root, CARBON_TABLE))


def run_grid(cells: DataFrame, root: str) -> DataFrame:
    rows = clean_grid(require_rows(cells, "no grid cells"))
    return cells.sparkSession.read.parquet(write_layer(rows, root, GRID_TABLE))


def run_daily(
    spark: SparkSession,
    stations_path: str,
    inventory_path: str,
    roots: Sequence[str],
    root: str,
    *,
    box: Box = Box(),
    max_stations: int | None = None,
    strict: bool = False,
    landed: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Station job from files; returns the written table and the stations without a file.

    ``landed`` are the lines of the same files as the raw layer holds them, in folders by prefix;
    with them only the folders of the selected stations are read.
    """
    stations = select_stations(
        read_lines(spark, stations_path, position=True),
        read_lines(spark, inventory_path),
        box=box,
        max_stations=max_stations,
    )
    stations = spark.read.parquet(write_layer(stations, shared_folder(spark, "stations"), "selected"))
    require_rows(stations, "no station matches the box and the inventory")
    ids = stations.select(F.col("station_id").alias("stem"))
    files = stored(keep_known(station_files(spark, roots), ids, "stem"), "station-files")
    missing = keep_missing(ids, files, "stem").withColumnRenamed("stem", "station_id")
    require_files(files)
    if landed is None:
        lines = read_selected_files(spark, files, roots)
    else:
        lines = of_files(prune_lines(landed, stations), files)
    size = None if max_stations is None else max_stations * STATION_BYTES
    rows = clean_daily(lines, small_side(stations, proven_bytes=size), strict=strict)
    return spark.read.parquet(write_layer(rows, root, DAILY_TABLE)), missing
