"""Fixed-width text: field layouts, the station list and its inventory."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import between_positions
from strata.functions.values import number
from strata.sources.lines import without_blank_lines

# The daily elements that are kept.
ELEMENTS = ("TMAX", "TMIN", "TAVG", "PRCP")


class Field(NamedTuple):
    """Characters ``start`` (0-based) up to but excluding ``end`` of a line."""

    name: str
    start: int
    end: int
    numeric: bool = False
    if_blank: float | None = None


# Published column positions of the station list and the inventory.
STATION_LAYOUT = (
    Field("station_id", 0, 11),
    Field("lat", 12, 20, numeric=True),
    Field("lon", 21, 30, numeric=True),
    Field("elevation", 31, 37, numeric=True, if_blank=0.0),
    Field("name", 41, 71),
)
INVENTORY_LAYOUT = (Field("station_id", 0, 11), Field("element", 31, 35))


def field_value(field: Field, line: Column | str = "value") -> Column:
    text = between_positions(line, field.start, field.end)
    if not field.numeric:
        return text.alias(field.name)
    if field.if_blank is None:
        return number(text).alias(field.name)
    value = F.when(text == "", F.lit(field.if_blank)).otherwise(number(text))
    return value.alias(field.name)


def parse_fixed_width(
    lines: DataFrame, layout: Sequence[Field], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per non-blank line with the layout's fields, plus the columns in ``keep``."""
    fields = [field_value(field) for field in layout]
    return without_blank_lines(lines).select(*fields, *keep)


def read_stations(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return parse_fixed_width(lines, STATION_LAYOUT, keep)


def inventory_stations(lines: DataFrame, elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """Distinct ids of the stations that report one of ``elements``."""
    entries = parse_fixed_width(lines, INVENTORY_LAYOUT)
    return entries.where(F.col("element").isin(list(elements))).select("station_id").distinct()
