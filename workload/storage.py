"""File listings, landing, layer sizes, reconciliation, the metrics document and its report."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.digests import differences
from strata.operators.storage import (
    compression,
    layer_sizes,
    reconcile,
    reconciliation_counts,
    total_bytes,
)
from strata.plans.evaluation import layer_files, metrics_document, run_evaluation, run_report
from strata.plans.landing import (
    land_raw,
    landed_files,
    landed_lines,
    landing_tree,
    reconcile_landing,
    source_files,
)
from strata.session import shared_folder
from strata.versions import versions
from strata.sinks import publish, read_layer, write_layer, write_merged
from strata.sources.files import manifest, missing_inputs
from workload.functions import _size_sql
from workload.quality import SCORES_SQL, scores
from workload.registry import query
from workload.shapes import rounded, table, write_named_files


@query("""
    SELECT * FROM (
        SELECT 'orders-' || CAST(o_orderkey % 5 AS VARCHAR) AS relative_path FROM orders
        UNION ALL SELECT 'customers-' || CAST(c_nationkey AS VARCHAR) FROM customer
    ) GROUP BY ALL HAVING relative_path LIKE 'customers%' AND count(*) > 0
""")
def missing_required_files(spark, sf_dir):
    """Names asked for by two tables; files were written for those of one, one of them empty."""
    root = shared_folder(spark, "required")
    number = (F.col("o_orderkey") % 5).cast("string")
    orders = table(spark, sf_dir, "orders").withColumn("stem", F.concat(F.lit("orders-"), number))
    text = F.when(number == "0", F.lit(None).cast("string")).otherwise(F.col("o_orderstatus"))
    orders = orders.withColumn("value", text)
    write_named_files(orders.where("value is not null"), f"{root}/in", "")
    write_named_files(spark.createDataFrame([("orders-0", "")], "stem string, value string"), f"{root}/in", "")
    customers = table(spark, sf_dir, "customer")
    nation = F.concat(F.lit("customers-"), F.col("c_nationkey").cast("string")).alias("relative_path")
    names = orders.select(F.col("stem").alias("relative_path")).unionByName(customers.select(nation))
    return missing_inputs(manifest(spark, f"{root}/in", "in"), names.distinct())


def _text_inputs(spark, sf_dir):
    """Conversations and event properties as text files."""
    root = shared_folder(spark, "text")
    conversations = table(spark, sf_dir, "conversations")
    spoken = F.regexp_replace("text", "[\\r\\n]", " ")
    conversations.select(F.concat_ws("\t", "role", spoken)).write.text(f"{root}/conversations")
    table(spark, sf_dir, "events").select("props").write.text(f"{root}/events")
    return root, {
        "conversations": [(f"{root}/conversations", "*.gz"), (f"{root}/conversations", "*.txt")],
        "events": [(f"{root}/events", "*.txt")],
    }


TEXT_SQL = """
    SELECT 'conversations' AS dataset, count(*) AS lines,
           sum(strlen(role) + 1 + strlen(text) + 1)::BIGINT AS bytes FROM conversations
    UNION ALL SELECT 'events', count(*), sum(strlen(props) + 1)::BIGINT FROM events
"""


@query(f"SELECT dataset, lines, bytes, {_size_sql('bytes::DOUBLE')} AS size FROM ({TEXT_SQL})")
def landed_text(spark, sf_dir):
    """Lines and bytes per landed dataset; bytes come from the listing, lines from the lines."""
    root, inputs = _text_inputs(spark, sf_dir)
    raw = f"{root}/raw"
    files = land_raw(spark, inputs, raw, text_datasets=list(inputs))
    sizes = total_bytes(files, "dataset").select("dataset", "bytes", "size")
    counts = [
        landed_lines(spark, raw, name).groupBy("dataset").agg(F.count(F.lit(1)).alias("lines"))
        for name in inputs
    ]
    return counts[0].unionByName(counts[1]).join(sizes, "dataset")


# Orders by status as text files, landed; of one file the lines of one priority are then lost.
DAMAGED_SQL = """
    SELECT 'orders/' || o_orderstatus || '.txt' AS relative_path,
           sum(strlen(o_orderpriority) + 1)::BIGINT AS local_bytes,
           coalesce(sum(strlen(o_orderpriority) + 1)
               FILTER (o_orderstatus <> 'F' OR o_orderpriority <> '5-LOW'), 0)::BIGINT AS stored_bytes,
           CASE WHEN o_orderstatus = 'F' THEN 'size_differs' ELSE 'same' END AS status
    FROM orders GROUP BY o_orderstatus
"""


@query(DAMAGED_SQL)
def landing_reconciled(spark, sf_dir):
    """Input files against landed files after one of these has lost lines."""
    root = shared_folder(spark, "damaged")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("stem"), F.col("o_orderpriority").alias("value")
    )
    write_named_files(orders, f"{root}/in", ".txt")
    inputs = {"orders": [(f"{root}/in", "*.txt")]}
    land_raw(spark, inputs, f"{root}/raw", text_datasets=["orders"])
    lines = landed_lines(spark, f"{root}/raw", "orders")
    lost = F.col("file_name").eqNullSafe("F.txt") & F.col("value").eqNullSafe("5-LOW")
    write_layer(lines.where(~lost), f"{root}/other", "lines", partition_by=["dataset"])
    stored = read_layer(spark, f"{root}/raw", "digests")
    write_layer(stored, f"{root}/other", "digests")
    files = source_files(spark, inputs, ["orders"])
    return reconcile_landing(files, landed_files(spark, f"{root}/other"))


@query("""
    SELECT '/orders/stem=' || o_orderstatus AS path, count(*) AS lines,
           sum(strlen(o_orderpriority) + 1)::BIGINT AS local_bytes,
           sum(strlen(o_orderpriority) + 1)::BIGINT AS stored_bytes,
           o_orderstatus <> 'F' AS same, o_orderstatus = 'F' AS opened
    FROM orders GROUP BY o_orderstatus
""")
def landing_folders_compared(spark, sf_dir):
    """Folders of input files against those landed after one letter of a line in one folder was changed."""
    root = shared_folder(spark, "folders")
    orders = table(spark, sf_dir, "orders")
    text = orders.select(F.col("o_orderstatus").alias("stem"), F.col("o_orderpriority").alias("value"), "o_orderkey")
    text.select("stem", "value").write.partitionBy("stem").text(f"{root}/in")
    inputs = {"orders": [(f"{root}/in", "*.txt")]}
    land_raw(spark, inputs, f"{root}/raw", text_datasets=["orders"])
    lines = read_layer(spark, f"{root}/raw", "lines")
    place = F.struct("file_path", "block_start", "row_id")
    first = lines.where(F.col("file_path").contains("stem=F")).agg(F.min(place).alias("place"))
    damaged = F.when(place == first.scalar(), F.overlay("value", F.lit("#"), F.lit(1))).otherwise(F.col("value"))
    write_layer(lines.withColumn("value", damaged), f"{root}/other", "lines", partition_by=["dataset"])
    write_layer(read_layer(spark, f"{root}/raw", "digests"), f"{root}/other", "digests")
    files = source_files(spark, inputs, ["orders"])
    local, kept = landing_tree(files), landing_tree(landed_files(spark, f"{root}/other"))
    changed, opened = differences(local, kept)
    folders = local.where("depth = 2").join(kept.select("path", F.col("bytes").alias("stored_bytes"), F.col("digest").alias("kept")), "path")
    counts = files.groupBy(F.concat(F.lit("/orders/"), F.substring_index("relative_path", "/", 1)).alias("path"))
    counts = counts.agg(F.sum("lines").alias("lines"))
    one = changed.where("status = 'content_differs'").agg(F.count(F.lit(1)).alias("n")).scalar() == 1
    looked_into = opened.where("path like '%=%'").select("path", F.lit(True).alias("looked_into"))
    return folders.join(counts, "path").join(looked_into, "path", "left").select(
        "path",
        "lines",
        F.col("bytes").alias("local_bytes"),
        "stored_bytes",
        (F.col("digest") == F.col("kept")).alias("same"),
        (F.coalesce("looked_into", F.lit(False)) & one).alias("opened"),
    )


# Supplier, part and customer names as the files of three written layers.
WRITTEN_SQL = """
    SELECT (SELECT sum(strlen(s_name) + 1) FROM supplier)::BIGINT AS bronze,
           (SELECT sum(strlen(p_name) + 1) FROM part)::BIGINT AS silver,
           (SELECT sum(strlen(c_name) + 1) FROM customer)::BIGINT AS gold
"""


@query(WRITTEN_SQL)
def written_layer_bytes(spark, sf_dir):
    """Bytes of three layers from the listing of their files."""
    root = shared_folder(spark, "layers")
    columns = {"bronze": ("supplier", "s_name"), "silver": ("part", "p_name"), "gold": ("customer", "c_name")}
    for layer, (source, column) in columns.items():
        table(spark, sf_dir, source).select(column).write.text(f"{root}/{layer}/table")
    return layer_sizes(layer_files(spark, {layer: f"{root}/{layer}" for layer in columns}))


# Customers and parts as two listings that overlap.
LISTINGS_SQL = """
    SELECT coalesce(l.k, s.k) AS relative_path, l.b AS local_bytes, s.b AS stored_bytes,
           CASE WHEN s.b IS NULL THEN 'only_local' WHEN l.b IS NULL THEN 'only_stored'
                WHEN l.b <> s.b THEN 'size_differs' ELSE 'same' END AS status
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS k, c_nationkey::BIGINT AS b
          FROM customer WHERE c_acctbal >= 0) l
    FULL JOIN (SELECT CAST(p_partkey AS VARCHAR) AS k, p_size::BIGINT AS b
               FROM part WHERE p_size <= 25) s ON l.k = s.k
"""


def _listings(spark, sf_dir):
    local = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    stored = table(spark, sf_dir, "part").where(F.col("p_size") <= 25)
    return reconcile(
        local.select(
            F.col("c_custkey").cast("string").alias("relative_path"),
            F.col("c_nationkey").cast("long").alias("length"),
        ),
        stored.select(
            F.col("p_partkey").cast("string").alias("relative_path"),
            F.col("p_size").cast("long").alias("length"),
        ),
    )


@query(LISTINGS_SQL)
def reconciled_files(spark, sf_dir):
    return _listings(spark, sf_dir)


@query(f"""
    SELECT count(local_bytes) AS local_files, count(stored_bytes) AS stored_files,
           count(*) FILTER (status <> 'same') AS differing_files,
           count(local_bytes) = count(stored_bytes) AS counts_match
    FROM ({LISTINGS_SQL})
""")
def reconciled_counts(spark, sf_dir):
    return reconciliation_counts(_listings(spark, sf_dir))


# Documents as files: English ones in bronze, Spanish ones in gold, the others in silver.
SIZES_SQL = """
    sizes AS (
        SELECT coalesce(sum(n_chars) FILTER (lang = 'en'), 0)::BIGINT AS bronze,
               coalesce(sum(n_chars) FILTER (lang IN ('de', 'fr')), 0)::BIGINT AS silver,
               coalesce(sum(n_chars) FILTER (lang = 'es'), 0)::BIGINT AS gold
        FROM documents
    )
"""


def _layer_files(spark, sf_dir):
    lang = F.col("lang")
    layer = F.when(lang == "en", "bronze").when(lang == "es", "gold").otherwise("silver")
    return table(spark, sf_dir, "documents").select(
        layer.alias("layer"), F.col("n_chars").alias("length")
    )


@query(f"WITH {SIZES_SQL} SELECT * FROM sizes")
def layer_bytes(spark, sf_dir):
    return layer_sizes(_layer_files(spark, sf_dir))


@query(f"""
    SELECT source, count(*) AS files, sum(n_chars)::BIGINT AS bytes,
           {_size_sql('sum(n_chars)::DOUBLE')} AS size
    FROM documents GROUP BY source
""")
def bytes_by_source(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumnRenamed("n_chars", "length")
    return total_bytes(documents, "source")


@query(f"""
    WITH {SIZES_SQL}
    SELECT round(bronze / silver, 6) AS bronze_to_silver, round(silver / gold, 6) AS silver_to_gold,
           CAST(NULL AS DOUBLE) AS without_gold
    FROM sizes
""")
def compression_ratios(spark, sf_dir):
    files = _layer_files(spark, sf_dir)
    ratios = rounded(
        compression(layer_sizes(files)), "bronze_to_silver", "silver_to_gold", digits=6
    )
    no_gold = compression(layer_sizes(files.where(F.col("layer") != "gold")))
    return ratios.withColumn("without_gold", no_gold.select("silver_to_gold").scalar())


@query("SELECT count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders")
def rerun_overwrites(spark, sf_dir):
    """A table written twice holds its rows once."""
    root = shared_folder(spark, "rerun")
    orders = table(spark, sf_dir, "orders")
    publish(orders, root, "orders")
    path = write_layer(orders, root, "orders")
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys")
    )


@query("""
    SELECT count(*) AS n, sum(o_custkey)::BIGINT AS keys, 1::BIGINT AS versions,
           sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::BIGINT AS lost_to_failure
    FROM orders
""")
def failed_rerun_keeps_the_table(spark, sf_dir):
    """A table after a rerun whose tasks fail on the urgent orders: the rows of the run before."""
    root = shared_folder(spark, "failed")
    orders = table(spark, sf_dir, "orders")
    publish(orders, root, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    failing = F.when(urgent, F.raise_error(F.lit("an urgent order"))).otherwise(F.col("o_custkey"))
    try:
        write_layer(orders.withColumn("o_custkey", failing), root, "orders")
    except Exception as error:
        if "an urgent order" not in str(error):
            raise
    kept = read_layer(spark, root, "orders")
    return kept.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_custkey").alias("keys"),
        F.lit(len(versions(spark, f"{root}/orders"))).cast("long").alias("versions"),
        F.count_if(urgent).alias("lost_to_failure"),
    )


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def merged_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    root = shared_folder(spark, "single")
    return spark.read.parquet(write_merged(counts, f"{root}/counts.parquet"))


def _metrics(spark, sf_dir):
    return metrics_document(
        scores(spark, sf_dir), _layer_files(spark, sf_dir), baseline_seconds=0.5
    )


def _document_sql() -> str:
    names = ("nasa", "gcb", "era5", "noaa", "overall")
    picks = ", ".join(
        f"max(round({side}, 6)) FILTER (dataset = '{n}') AS {n}_{side.split('_')[0]}"
        for n in names
        for side in ("raw_score", "silver_score")
    )
    return f"""
        {SCORES_SQL}, {SIZES_SQL}
        SELECT s.*, q.* FROM
          (SELECT bronze, silver, gold, {_size_sql('bronze::DOUBLE')} AS bronze_human,
                  round(silver / gold, 6) AS silver_to_gold, 0.5::DOUBLE AS baseline FROM sizes) s,
          (SELECT {picks} FROM all_scores) q
    """


@query(_document_sql())
def evaluation_document(spark, sf_dir):
    """The metrics document written as JSON and read back, flattened."""
    path = f"{shared_folder(spark, 'metrics')}/metrics.json"
    document = run_evaluation(_metrics(spark, sf_dir), path)
    names = ("nasa", "gcb", "era5", "noaa", "overall")
    quality = [
        F.round(f"data_quality.{n}.{side}_score", 6).alias(f"{n}_{side}")
        for n in names
        for side in ("raw", "silver")
    ]
    return document.select(
        "storage_bytes.*",
        F.col("storage_human.bronze").alias("bronze_human"),
        F.round("compression_ratio.silver_to_gold", 6).alias("silver_to_gold"),
        F.col("latency_seconds.baseline_query").alias("baseline"),
        *quality,
    )


_REPORT_LABELS = (
    ("nasa", "NASA"),
    ("gcb", "GCB"),
    ("era5", "ERA5"),
    ("noaa", "NOAA"),
    ("overall", "Overall"),
)
_METRIC_ROWS = ", ".join(
    f"({position}, 'metric', '{label}', {value})"
    for position, (label, value) in enumerate(
        (
            ("Medallion query latency (s)", "'n/a'"),
            ("Baseline query latency (s)", "'0.5000'"),
            ("Bronze size", f"(SELECT {_size_sql('bronze::DOUBLE')} FROM sizes)"),
            ("Silver size", f"(SELECT {_size_sql('silver::DOUBLE')} FROM sizes)"),
            ("Gold size", f"(SELECT {_size_sql('gold::DOUBLE')} FROM sizes)"),
            ("Compression Bronze→Silver", "(SELECT printf('%.2fx', bronze / silver) FROM sizes)"),
            ("Compression Silver→Gold", "(SELECT printf('%.2fx', silver / gold) FROM sizes)"),
        ),
        1,
    )
)


@query(f"""
    {SCORES_SQL}, {SIZES_SQL}
    SELECT position, section, label, value, CAST(NULL AS VARCHAR) AS silver_value
    FROM (VALUES {_METRIC_ROWS}, (8, 'note', 'latency', 'n/a')) v(position, section, label, value)
    UNION ALL
    SELECT p.position, 'quality', p.label, printf('%.4f', s.raw_score),
           printf('%.4f', s.silver_score)
    FROM all_scores s JOIN (VALUES {', '.join(
        f"({9 + i}, '{name}', '{label}')" for i, (name, label) in enumerate(_REPORT_LABELS)
    )}) p(position, name, label) ON p.name = s.dataset
""")
def report_rows(spark, sf_dir):
    """Report rows of the stored document; the layered latency was not measured."""
    path = f"{shared_folder(spark, 'report')}/metrics.json"
    run_evaluation(_metrics(spark, sf_dir), path)
    return run_report(spark, path)
