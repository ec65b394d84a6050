"""Date and time expressions that give NULL, not an error, on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import as_column, strip, zero_padded

# The month columns of the anomaly table.
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MONTH_LABELS = tuple(f"{index:02d}" for index in range(1, 13))


def month_number(name: Column | str) -> Column:
    """1 for ``Jan`` … 12 for ``Dec``; NULL for other text."""
    names = F.array(*[F.lit(month) for month in MONTH_NAMES])
    return F.nullif(F.array_position(names, as_column(name)), F.lit(0)).cast("int")


def date_from_parts(year: Column | str, month: Column | str, day: Column | str = "") -> Column:
    """Calendar date, the first of the month without ``day``; an impossible day gives NULL."""
    day_text = zero_padded(day, 2) if not isinstance(day, str) or day else F.lit("01")
    text = F.concat(
        zero_padded(year, 4), F.lit("-"), zero_padded(month, 2), F.lit("-"), day_text
    )
    return F.try_to_date(text)


def days_in_month(first_day: Column) -> Column:
    return F.dayofmonth(F.last_day(first_day))


def text_to_date(column: Column | str) -> Column:
    return F.try_to_date(strip(column))


def text_to_timestamp(column: Column | str) -> Column:
    return F.try_to_timestamp(strip(column))


def to_second(column: Column | str) -> Column:
    """Timestamp without its sub-second part."""
    return F.date_trunc("second", as_column(column))


def second_text(column: Column | str) -> Column:
    return F.date_format(to_second(column), "yyyy-MM-dd HH:mm:ss")


def month_bucket(column: Column | str) -> Column:
    """First day of the month as DATE, for DATE and timestamp input alike."""
    return F.trunc(as_column(column).cast("date"), "MM")
