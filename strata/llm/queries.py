"""The corpus operators over the given tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    conversations,
    decontamination,
    hard_negatives,
    licenses,
    neardup,
    oracles,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    suffixes,
    toxicity,
    warc,
)
from strata.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of 16, interleaved by source."""
    rows = sharding.interleave(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to the archive and read back."""
    folder = warc.write_archive(table(spark, sf_dir, "pages"), shared_folder(spark, "archive"))
    return warc.resolve(spark, folder).select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "intact",
    )


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line and document rules on every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("cleaned")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), **packing.public_files())


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.detect(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low quality, then toxicity, of every document, by a chain fitted on the labelled ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    chain = toxicity.fit_chain(docs, labels, ["poor", "toxic"])
    return toxicity.flag(toxicity.score(docs, chain), ["poor", "toxic"])


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence texts and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 100-byte strings that occur earlier."""
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.find_items(docs, items)


@query
def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates among all documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, every seventh label being moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with one row in five damaged, each kind by the checksum of its id and turn."""
    name = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(name("text"), ".!?", "")).otherwise(name("text"))
    copies = F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"), F.explode(copies)
    ).drop("col")


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired at the least cost."""
    rows = table(spark, sf_dir, "conversations")
    summary, _ = conversations.repair(_damaged(rows))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    ids = rows.select("conv_id").distinct()
    return ids.join(summary, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id",
        *[F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled neighbours; a quarter of the ids is held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    voters = quality_classifier.fit(docs, labels.where(~held_out), F.col("quality"))
    return quality_classifier.score(docs, voters).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


ORACLE |= {
    "op1_suffixes": oracles.OP1,
    "op7_neardup": oracles.OP7,
    "op8_sharding": oracles.OP8,
    "op9_warc": oracles.OP9,
    "op10_quality": oracles.OP10,
    "op11_hard_negatives": oracles.OP11,
    "op12_conversations": oracles.OP12,
}
