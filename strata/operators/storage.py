"""File counts and sizes per layer, compression, and reconciliation of two listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import human_size
from strata.functions.values import ratio


def total_bytes(files: DataFrame, group: str) -> DataFrame:
    """``(group, files, bytes, size)`` per value of a column of a file listing."""
    totals = files.groupBy(group).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
    return totals.withColumn("size", human_size("bytes"))


def layer_sizes(files: DataFrame, layer: str = "layer") -> DataFrame:
    """One row with the bytes of the bronze, silver and gold layers, 0 for an empty layer."""

    def of(name: str) -> Column:
        size = F.sum(F.when(F.col(layer) == name, F.col("length")))
        return F.coalesce(size, F.lit(0)).cast("long").alias(name)

    return files.agg(of("bronze"), of("silver"), of("gold"))


def compression(sizes: DataFrame) -> DataFrame:
    """Bytes of a layer per byte of the next one, NULL when the next one is empty."""
    return sizes.select(
        ratio(F.col("bronze"), F.col("silver")).alias("bronze_to_silver"),
        ratio(F.col("silver"), F.col("gold")).alias("silver_to_gold"),
    )


def reconcile(
    local: DataFrame, stored: DataFrame, key: str = "relative_path", *, content: str | None = None
) -> DataFrame:
    """One row per file of either listing: its size on each side and whether it is on both.

    Files of equal size are held to each other by the column ``content``, a digest, if it is given.
    """
    sides = []
    for side, listing in (("local", local), ("stored", stored)):
        digest = F.col(content) if content else F.lit(None).cast("string")
        sides.append(listing.select(key, F.col("length").alias(f"{side}_bytes"), digest.alias(f"{side}_digest")))
    status = (
        F.when(F.col("stored_bytes").isNull(), "only_local")
        .when(F.col("local_bytes").isNull(), "only_stored")
        .when(F.col("local_bytes") != F.col("stored_bytes"), "size_differs")
        .when(~F.col("local_digest").eqNullSafe(F.col("stored_digest")), "content_differs")
        .otherwise("same")
    )
    joined = sides[0].join(sides[1], key, "full_outer").withColumn("status", status)
    return joined.drop("local_digest", "stored_digest")


def reconciliation_counts(files: DataFrame) -> DataFrame:
    """One row: files per side, files that differ, and whether the two counts agree."""
    counts = files.agg(
        F.count("local_bytes").alias("local_files"),
        F.count("stored_bytes").alias("stored_files"),
        F.count_if(F.col("status") != "same").alias("differing_files"),
    )
    return counts.withColumn("counts_match", F.col("local_files") == F.col("stored_files"))
