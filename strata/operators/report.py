"""The metrics document as report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import MISSING_TEXT, four_decimals, ratio_text

# The labels of the report, in its order.
METRIC_ROWS = (
    ("Medallion query latency (s)", "latency_seconds.medallion_query", four_decimals),
    ("Baseline query latency (s)", "latency_seconds.baseline_query", four_decimals),
    ("Bronze size", "storage_human.bronze", None),
    ("Silver size", "storage_human.silver", None),
    ("Gold size", "storage_human.gold", None),
    ("Compression Bronze→Silver", "compression_ratio.bronze_to_silver", ratio_text),
    ("Compression Silver→Gold", "compression_ratio.silver_to_gold", ratio_text),
)
QUALITY_ROWS = (
    ("NASA", "nasa"),
    ("GCB", "gcb"),
    ("ERA5", "era5"),
    ("NOAA", "noaa"),
    ("Overall", "overall"),
)


def _row(order: int, section: str, label: str, value: Column, silver: Column) -> Column:
    return F.struct(
        F.lit(order).alias("position"),
        F.lit(section).alias("section"),
        F.lit(label).alias("label"),
        value.alias("value"),
        silver.alias("silver_value"),
    )


def report_rows(metrics: DataFrame) -> DataFrame:
    """``(position, section, label, value, silver_value)``; missing entries read ``n/a``.

    Quality rows have the raw score in ``value`` and the cleaned one in ``silver_value``.
    """
    rows = []
    no_text = F.lit(None).cast("string")
    for label, path, show in METRIC_ROWS:
        text = show(path) if show else F.coalesce(F.col(path), F.lit(MISSING_TEXT))
        rows.append(_row(len(rows) + 1, "metric", label, text, no_text))
    note = F.coalesce(F.col("notes.latency"), F.lit(MISSING_TEXT))
    rows.append(_row(len(rows) + 1, "note", "latency", note, no_text))
    for label, name in QUALITY_ROWS:
        raw, silver = (f"data_quality.{name}.{side}_score" for side in ("raw", "silver"))
        rows.append(
            _row(len(rows) + 1, "quality", label, four_decimals(raw), four_decimals(silver))
        )
    return metrics.select(F.inline(F.array(*rows)))
