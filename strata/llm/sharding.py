"""Proportional stratified interleaving: shards that all hold the mixture of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bits_for, numbered, settle, text_or_empty

HEX_DIGITS = 15  # of the drawn hash that are read as a number; 60 bits fit a long


def interleave(
    docs: DataFrame,
    *,
    n_shards: int = 16,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Deal documents into shards that each hold every source in its share of the whole.

    Rows are put in a seeded random order within their source, which gives row ``r`` of ``n`` the
    fractional rank ``(r + 1/2) / n``. All rows sorted by that rank interleave the sources in
    proportion at every point, so cutting the order into ``n_shards`` stretches of equal length (at
    most one row apart) gives each shard the mixture of the whole.

    Returns ``doc_id, source, size, text_crc32, shard, slot, rank``; ``slot`` counts from 0 without
    gaps. NULL sources form a source of their own; NULL texts have size 1 and CRC 0; rows with a NULL
    id or an id that occurs twice are dealt like any other; an empty table gives no rows.
    """
    text = text_or_empty(text_col)
    drawn = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("stratum"),
        drawn.alias("drawn"),
    )
    rows = settle(rows, "shard-rows")
    n_rows = rows.count()
    bits = bits_for(n_rows)
    number = F.conv(F.substring("drawn", 1, HEX_DIGITS), 16, 10).cast("long")
    rows = rows.withColumn("part", F.shiftright(number, 4 * HEX_DIGITS - bits))
    order = ["drawn", "doc_id", "size", "text_crc32"]
    ranked = numbered(rows, ["stratum"], "part", order, "place")
    rank = (F.col("place") + F.lit(0.5)) / F.col("place_of")
    ranked = settle(ranked.withColumn("rank", rank).drop("part", "place", "place_of"), "shard-ranks")
    ranked = ranked.withColumn("part", F.floor(F.col("rank") * (1 << bits)))
    placed = numbered(ranked, [], "part", ["rank", "stratum", *order], "place")
    shard = F.expr(f"cast((place * {n_shards}) div place_of as int)")
    first = F.expr(f"(_shard * place_of + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("_shard", shard).select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.col("_shard").alias("shard"),
        (F.col("place") - first).cast("long").alias("slot"),
        "rank",
    )
