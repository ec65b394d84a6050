"""Joins of rows with facts about their key, where a third of the rows has the same key."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import warc
from strata.llm.common import join_facts, settle
from strata.session import shared_folder


def test_rows_of_a_heavy_key_stay_where_they_are(spark):
    changed = {
        "spark.sql.shuffle.partitions": "100",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 != 1, F.col("id").cast("string"))
        rows = settle(spark.range(0, 30_000, 1, 24).withColumn("k", key), "rows")
        facts = rows.where("k is not null and id % 7 != 0 or id = 0").groupBy("k").agg(F.min("id").alias("least"))
        joined = join_facts(rows, settle(facts, "facts"), "k")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] < 3_000
        expected = rows.join(facts, "k", "left")
        assert joined.columns == expected.columns and joined.count() == 30_000
        assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
        assert join_facts(rows.limit(0), facts, "k").isEmpty()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_archive_with_one_payload_on_a_third_of_the_pages(spark):
    html = F.when(F.col("id") % 3 == 0, "<p>shared</p>").otherwise(F.concat(F.lit("<p>"), F.col("id").cast("string")))
    pages = spark.range(900).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    got = warc.resolve(spark, warc.write_archive(pages, shared_folder(spark, "hot"))).collect()
    assert len(got) == 900 and all(row["intact"] for row in got)
    revisits = {row["id"] for row in got if row["record_type"] == "revisit"}
    assert revisits == set(range(3, 900, 3)) and all(row["refers_to"] == 0 for row in got if row["id"] in revisits)
