"""Numbers out of raw text: safe casts, sentinels, NaN, scale and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strata.functions.text import as_column, quoted, strip

# What counts as a number in text. A cast of other text costs an exception per value, and Java
# would also take spellings such as `1d`, so text is matched before it is cast.
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
WHOLE_NUMBER_TEXT = r"^\s*[+-]?\d+\s*$"


def nan_to_null(column: Column | str) -> Column:
    """NaN counts as missing; otherwise one NaN turns a whole mean into NaN."""
    return F.nullif(as_column(column).cast("double"), F.lit(float("nan")))


def number(column: Column | str) -> Column:
    """Text to double; text that is no number, NaN included, becomes NULL."""
    text = as_column(column)
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """A column as double without NaN; text is parsed, numbers are only cast."""
    column = quoted(name)
    if isinstance(df.schema[name].dataType, NumericType):
        return nan_to_null(column)
    return number(F.col(column).cast("string"))


def whole_number(column: Column | str) -> Column:
    """Text to int; anything that is not a whole number becomes NULL."""
    text = as_column(column)
    return F.when(text.rlike(WHOLE_NUMBER_TEXT), text.try_cast("int"))


def without_sentinel(column: Column | str, *sentinels: str) -> Column:
    """Trimmed text with every sentinel spelling replaced by NULL."""
    text = strip(column)
    for sentinel in sentinels:
        text = F.nullif(text, F.lit(sentinel))
    return text


def scaled(column: Column | str, divisor: float) -> Column:
    return as_column(column).cast("double") / F.lit(float(divisor))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when there is nothing to count."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL when the divisor is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def required(column: Column, malformed: Column, message: str) -> Column:
    """The column itself, but a row for which ``malformed`` holds fails the job."""
    return F.when(malformed, F.raise_error(F.lit(message))).otherwise(column)
