"""Explicit schemas of the layer tables. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


# Cleaned layer: one observation per row.
ANOMALY = _schema(
    ("year", IntegerType(), True),
    ("month", StringType(), False),
    ("date", DateType(), True),
    ("anomaly", DoubleType(), True),
)
CARBON = _schema(
    ("year", IntegerType(), False),
    ("metric", StringType(), False),
    ("value", DoubleType(), False),
)
GRID = _schema(
    ("time", TimestampType(), True),
    ("variable", StringType(), True),
    ("value", DoubleType(), True),
    ("units", StringType(), True),
    ("source_file", StringType(), True),
)
STATION_DAILY = _schema(
    ("station_id", StringType(), False),
    ("date", DateType(), False),
    ("element", StringType(), False),
    ("value", DoubleType(), True),
    ("lat", DoubleType(), True),
    ("lon", DoubleType(), True),
    ("elevation", DoubleType(), True),
    ("name", StringType(), True),
    ("mflag", StringType(), True),
    ("qflag", StringType(), True),
    ("sflag", StringType(), True),
)

# Aggregated layer.
TREND = _schema(
    ("date", DateType(), True),
    ("source", StringType(), False),
    ("variable", StringType(), True),
    ("unit", StringType(), True),
    ("value", DoubleType(), True),
)
CARBON_ANNUAL = _schema(
    ("year", IntegerType(), True),
    ("metric", StringType(), True),
    ("value", DoubleType(), True),
)
MULTI_SOURCE = _schema(
    ("year", IntegerType(), True),
    ("nasa_anomaly", DoubleType(), True),
    ("era5_value", DoubleType(), True),
    ("gcb_value", DoubleType(), True),
    ("era5_variable", StringType(), True),
    ("gcb_metric", StringType(), True),
)

# File listing and landed lines.
MANIFEST = _schema(
    ("dataset", StringType(), False),
    ("relative_path", StringType(), False),
    ("path", StringType(), False),
    ("length", LongType(), False),
    ("modificationTime", TimestampType(), True),
)

# The metrics document.
_SCORES = _schema(("raw_score", DoubleType(), True), ("silver_score", DoubleType(), True))
_BYTES = _schema(*[(layer, LongType(), True) for layer in ("bronze", "silver", "gold")])
_SIZES = _schema(*[(layer, StringType(), True) for layer in ("bronze", "silver", "gold")])
METRICS = _schema(
    (
        "latency_seconds",
        _schema(("medallion_query", DoubleType(), True), ("baseline_query", DoubleType(), True)),
        True,
    ),
    ("notes", _schema(("latency", StringType(), True)), True),
    ("storage_bytes", _BYTES, True),
    ("storage_human", _SIZES, True),
    (
        "compression_ratio",
        _schema(("bronze_to_silver", DoubleType(), True), ("silver_to_gold", DoubleType(), True)),
        True,
    ),
    (
        "data_quality",
        _schema(*[(name, _SCORES, True) for name in ("nasa", "gcb", "era5", "noaa", "overall")]),
        True,
    ),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns in its order, cast to its types."""

    def cast(field: StructField) -> Column:
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return df.select(*[cast(field) for field in schema.fields])
