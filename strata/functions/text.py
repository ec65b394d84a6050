"""Text expressions: trimming, positions, names, paths and number formatting."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"
MISSING_TEXT = "n/a"
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def quoted(name: str) -> str:
    """A column name that may hold dots or blanks, as a reference."""
    return "`" + name.replace("`", "``") + "`"


def strip(column: Column | str) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` removes only blanks).

    Blanks, which are most of it, go first: a search among several characters costs far more for each of them.
    """
    return F.btrim(F.trim(as_column(column)), F.lit(WHITESPACE))


def blank_to_null(column: Column | str) -> Column:
    return F.nullif(strip(column), F.lit(""))


def is_blank(column: Column | str) -> Column:
    return strip(column) == ""


def between_positions(column: Column | str, start: int, end: int) -> Column:
    """Characters ``start`` (0-based) up to but excluding ``end``, trimmed."""
    return strip(F.substring(as_column(column), start + 1, end - start))


def character_or_null(column: Column | str, index: int) -> Column:
    """The character at ``index`` (0-based); NULL if it is white space or beyond the end."""
    character = F.substring(as_column(column), index + 1, 1)
    return F.when(~character.isin("", *WHITESPACE), character)


def contains_any_case(column: Column | str, part: str) -> Column:
    return F.contains(F.lower(as_column(column)), F.lit(part))


def zero_padded(column: Column | str, width: int) -> Column:
    """Text with leading zeros up to ``width``; longer text is left whole."""
    text = strip(as_column(column).cast("string"))
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def snake_case(column: Column | str) -> Column:
    """Lower-case name in which every run of other characters is one underscore."""
    joined = F.regexp_replace(as_column(column), "[^0-9a-zA-Z]+", "_")
    trimmed = F.lower(F.btrim(joined, F.lit("_")))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit("col"))


def snake_name(name: object) -> str:
    """``snake_case`` for a column name that is known while the plan is built."""
    return "_".join(re.findall("[0-9a-zA-Z]+", str(name))).lower() or "col"


def plain_path(metadata_path: Column | str) -> Column:
    """A path or name from file metadata, which is URL-encoded, as it stands in the file system."""
    return F.url_decode(F.replace(as_column(metadata_path), F.lit("+"), F.lit("%2B")))


def base_name(path: Column | str) -> Column:
    """Last part of a path."""
    return F.substring_index(as_column(path), "/", -1)


def file_stem(path: Column | str) -> Column:
    """Base name without its last suffix; a name that only starts with a dot keeps it."""
    name = base_name(path)
    stem = F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)
    return F.when(stem == "", name).otherwise(stem)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def exact_decimals(column: Column | str, digits: int) -> Column:
    """The stored binary value rounded to ``digits`` decimals, exact ties to even, as text
    with at least one decimal.

    ``value * 10**digits`` is taken as a rounded product and its exact error: the value is split in
    halves of 26 bits, whose products with the power are exact. The error decides where the rounded
    product ends in one half; from 2**52 on the product has no fraction, and the error has it all.
    From 2**62 on Java's text is taken.
    """
    power = float(10**digits)

    def split(size: Column) -> Column:
        high = size * 134217729.0 - (size * 134217729.0 - size)
        error = (high * power - size * power) + (size - high) * power
        return F.struct((size * power).alias("product"), error.alias("error"))

    def whole_number(x: Column) -> Column:
        large = x["product"] >= 2.0**52
        whole = F.floor(x["product"]) + F.when(large, F.floor(x["error"])).otherwise(0)
        rest = F.when(large, x["error"] - F.floor(x["error"])).otherwise(x["product"] - whole)
        odd_or_above = (~large & (x["error"] > 0)) | ((large | (x["error"] == 0)) & (whole % 2 == 1))
        return whole + ((rest > 0.5) | ((rest == 0.5) & odd_or_above)).cast("long")

    def padded(number: Column) -> Column:
        text = number.cast("string")
        return F.lpad(text, F.greatest(F.length(text), F.lit(digits + 1)), F.lit("0"))

    def pointed(text: Column) -> Column:
        units = F.substring(text, F.lit(1), F.length(text) - digits)
        return F.concat(units, F.lit("."), F.right(text, F.lit(digits)))

    def written(value: Column) -> Column:
        fits = F.abs(value) * power < 2.0**62
        size = F.when(fits, F.abs(value))
        text = let(let(let(let(size, split), whole_number), padded), pointed)
        signed = F.concat(F.when(value < 0, "-").otherwise(""), text)
        return F.when(fits, signed).when(value.isNotNull(), F.format_string(f"%.{digits}f", value))

    return let(as_column(column).cast("double"), written)


def fixed_decimals(column: Column | str, digits: int, suffix: str = "") -> Column:
    """Number with a fixed count of decimals; missing values read ``n/a``."""
    value = as_column(column).cast("double")
    return F.coalesce(F.concat(exact_decimals(value, digits), F.lit(suffix)), F.lit(MISSING_TEXT))


def four_decimals(column: Column | str) -> Column:
    return fixed_decimals(column, 4)


def ratio_text(column: Column | str) -> Column:
    return fixed_decimals(column, 2, "x")


def human_size(column: Column | str) -> Column:
    """Bytes as ``1.5KB``: one decimal, base 1024; NULL stays NULL."""
    size = as_column(column).cast("double")
    last = len(SIZE_UNITS) - 1
    value, unit = size / F.lit(1024.0**last), F.lit(SIZE_UNITS[last])
    for power in reversed(range(last)):
        below = size < F.lit(1024.0 ** (power + 1))
        value = F.when(below, size / F.lit(1024.0**power)).otherwise(value)
        unit = F.when(below, SIZE_UNITS[power]).otherwise(unit)
    return F.when(size.isNotNull(), F.concat(exact_decimals(value, 1), unit))
