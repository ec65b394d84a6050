"""Evaluation of the layers: quality scores, sizes, compression, and the metrics document."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.dates import MONTH_NAMES
from strata.functions.text import human_size
from strata.operators.quality import (
    Counts,
    daily_counts,
    daily_quality,
    grid_counts,
    grid_quality,
    numeric_quality,
    presence_counts,
    presence_quality,
    range_counts,
    range_quality,
    score_table,
    scored,
    wide_quality,
    with_overall,
)
from strata.operators.report import report_rows
from strata.operators.states import refresh_states, shares_of_states
from strata.operators.storage import compression, layer_sizes
from strata.sinks import write_metrics
from strata.sources.files import manifest_if_present
from strata.sources.fixed_width import ELEMENTS
from strata.sources.tables import read_metrics

DATASETS = ("nasa", "gcb", "era5", "noaa")
LAYERS = ("bronze", "silver", "gold")


def quality_scores(
    raw: Mapping[str, DataFrame],
    silver: Mapping[str, DataFrame],
    *,
    elements: Sequence[str] = ELEMENTS,
) -> DataFrame:
    """``(dataset, layer, score)`` of the four datasets and their mean, for both layers.

    Raw tables: wide text months with NULL for missing marks, the sheet, grid means, daily rows.
    """
    shares = {
        ("nasa", "raw"): wide_quality(raw["nasa"], MONTH_NAMES),
        ("nasa", "silver"): range_quality(silver["nasa"], "anomaly"),
        ("gcb", "raw"): numeric_quality(raw["gcb"]),
        ("gcb", "silver"): presence_quality(silver["gcb"], "value"),
        ("era5", "raw"): grid_quality(raw["era5"]),
        ("era5", "silver"): grid_quality(silver["era5"]),
        ("noaa", "raw"): daily_quality(raw["noaa"], elements),
        ("noaa", "silver"): daily_quality(silver["noaa"], elements),
    }
    rows = [scored(quality, dataset, layer) for (dataset, layer), quality in shares.items()]
    return with_overall(reduce(DataFrame.unionByName, rows))


def silver_counts(elements: Sequence[str] = ELEMENTS) -> dict[str, Callable[[DataFrame], Counts]]:
    """What is counted in the files of each cleaned table."""
    return {
        "nasa": lambda df: range_counts("anomaly"),
        "gcb": lambda df: presence_counts("value"),
        "era5": grid_counts,
        "noaa": lambda df: daily_counts(df, elements),
    }


def refreshed_scores(
    spark: SparkSession, folders: Mapping[str, str], root: str, *, elements: Sequence[str] = ELEMENTS
) -> DataFrame:
    """``(dataset, layer, score)`` of stored cleaned tables, reading only files that no run before has counted.

    ``folders`` names the folder of data files of each dataset; the counts are kept below ``root``.
    """
    counts = silver_counts(elements)
    rows = []
    for dataset, folder in folders.items():
        states = refresh_states(spark, folder, root, dataset, counts[dataset])
        rows.append(scored(shares_of_states(states), dataset, "silver"))
    return reduce(DataFrame.unionByName, rows)


def layer_files(spark: SparkSession, roots: Mapping[str, str]) -> DataFrame:
    """Files of the bronze, silver and gold folders with their layer."""
    listings = [
        manifest_if_present(spark, roots[layer], layer).withColumnRenamed("dataset", "layer")
        for layer in LAYERS
    ]
    return reduce(DataFrame.unionByName, listings)


def metrics_document(
    scores: DataFrame,
    files: DataFrame,
    *,
    medallion_seconds: float | None = None,
    baseline_seconds: float | None = None,
    note: str | None = None,
) -> DataFrame:
    """The metrics as one row of nested columns."""
    sizes = layer_sizes(files)
    table = score_table(scores)

    def scores_of(dataset: str):
        pair = F.struct("raw_score", "silver_score")
        return F.max(F.when(F.col("dataset") == dataset, pair)).alias(dataset)

    names = (*DATASETS, "overall")
    quality = table.agg(*[scores_of(name) for name in names]).select(F.struct(*names).alias("q"))
    ratios = compression(sizes).select(F.struct("bronze_to_silver", "silver_to_gold").alias("r"))
    document = sizes.select(
        F.struct(
            F.lit(medallion_seconds).cast("double").alias("medallion_query"),
            F.lit(baseline_seconds).cast("double").alias("baseline_query"),
        ).alias("latency_seconds"),
        F.struct(F.lit(note).cast("string").alias("latency")).alias("notes"),
        F.struct(*LAYERS).alias("storage_bytes"),
        F.struct(*[human_size(layer).alias(layer) for layer in LAYERS]).alias("storage_human"),
        ratios.scalar().alias("compression_ratio"),
        quality.scalar().alias("data_quality"),
    )
    return schemas.conform(document, schemas.METRICS)


def run_evaluation(metrics: DataFrame, path: str) -> DataFrame:
    """Write the metrics document and return it as read back."""
    return read_metrics(metrics.sparkSession, write_metrics(metrics, path))


def run_report(spark: SparkSession, path: str) -> DataFrame:
    """Report rows of a stored metrics document."""
    return report_rows(read_metrics(spark, path))
