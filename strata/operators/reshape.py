"""Wide to long, column names, and columns without content."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import MONTH_LABELS, MONTH_NAMES, date_from_parts
from strata.functions.text import as_column, quoted, snake_name
from strata.functions.values import as_number, number, whole_number, without_sentinel
from strata.sources.delimited import MISSING_MARK

# Years outside this range are not years.
FIRST_YEAR = 1800
LAST_YEAR = 2100


def unpivot_columns(
    df: DataFrame, ids: Sequence[str | Column], columns: Sequence[str], variable: str, value: str
) -> DataFrame:
    """One row per id row and column, NULL values included; columns must share one type."""
    keys = [F.col(quoted(i)) if isinstance(i, str) else i for i in ids]
    return df.unpivot(keys, [F.col(quoted(c)) for c in columns], variable, value)


def months_to_rows(wide: DataFrame, year: str = "Year") -> DataFrame:
    """Year rows with twelve text columns to ``(year, month, date, anomaly)``, NULLs kept."""
    values = [
        number(without_sentinel(quoted(name), MISSING_MARK)).alias(label)
        for name, label in zip(MONTH_NAMES, MONTH_LABELS, strict=True)
    ]
    numbered = wide.select(whole_number(quoted(year)).alias("year"), *values)
    long = unpivot_columns(numbered, ["year"], MONTH_LABELS, "month", "anomaly")
    return long.select("year", "month", date_from_parts("year", "month").alias("date"), "anomaly")


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to snake case; two columns with one name are an error."""
    names = [snake_name(name) for name in df.columns]
    repeated = sorted(name for name, count in Counter(names).items() if count > 1)
    if repeated:
        raise ValueError(f"column names equal after normalising: {', '.join(repeated)}")
    return df.toDF(*names)


def year_column(columns: Sequence[str]) -> str:
    """The first name that contains ``year``, else the first name."""
    return next((name for name in columns if "year" in name), columns[0])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold only NULL. Counts all columns in one pass over the data."""
    # The counts are one row, so the choice of columns needs no data on the driver.
    counts = df.agg(
        *[F.count(quoted(name)).alias(str(i)) for i, name in enumerate(df.columns)]
    ).first()
    return df.select(*[F.col(quoted(n)) for i, n in enumerate(df.columns) if counts[str(i)]])


def valid_years(df: DataFrame, year: Column | str) -> DataFrame:
    """Rows whose year is numeric and in range."""
    return df.where(as_column(year).between(FIRST_YEAR, LAST_YEAR))


def sheet_to_rows(sheet: DataFrame) -> DataFrame:
    """A wide sheet with any columns to ``(year, metric, value)`` without missing values."""
    named = snake_case_columns(sheet)
    year = year_column(named.columns)
    metrics = [name for name in named.columns if name != year]
    numeric = named.select(*[as_number(named, name).alias(name) for name in (year, *metrics)])
    dated = valid_years(numeric, year)
    whole_year = F.col(year).cast("int").alias("year")
    long = unpivot_columns(dated, [whole_year], metrics, "metric", "value")
    return long.where(F.col("value").isNotNull())
