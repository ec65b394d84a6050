"""From raw documents to packed token sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read back as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, neardup, packing, pii, quality_rules
from strata.llm.common import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that failed them.

    A NULL, empty or blank text is rejected, as it has under 20 words; a text of any length is judged whole. Rows
    given twice pass or fail twice, and so do rows with a NULL id. An empty table stays empty.
    """
    return _recounted(quality_rules.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates.

    Texts without words belong to no group and stay. Of rows that share the least id of a group all stay, those
    with a NULL id among them. Long texts are compared by all their shingles. An empty table stays empty.
    """
    return neardup.without_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    NULL and empty texts hold none, and NULL or empty items are in no document. A row goes by its id: rows that share
    one go together, rows with a NULL id as one document. Every place of a long text is looked at; an empty table of
    documents or items takes nothing away.
    """
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    Every row stays, whatever its id and also where it is given twice. NULL texts stay NULL. Of spans that
    overlap the one that starts first is named. An empty table stays empty.
    """
    return _recounted(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, in sequences.

    A NULL or empty text is the end mark alone; longer documents than a sequence are cut. Rows given twice, or with a
    NULL id, are packed as documents of their own. An empty table gives no pieces.
    """
    return packing.pack_documents(docs, **packing.public_files())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("personal data", personal_data),
    ("packing", pack),
]

# Similarity, fingerprints and tokens have no SQL; the stages are held to brute force in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
