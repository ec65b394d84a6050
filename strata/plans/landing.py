"""Raw layer: the lines of text inputs and the listing of all input files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.functions.text import base_name
from strata.operators.digests import file_digests, tree
from strata.operators.storage import reconcile
from strata.sinks import read_layer, write_layer
from strata.sources.files import first_available, of_paths, require_inputs
from strata.sources.lines import read_lines

LINES = "lines"
FILES = "files"
DIGESTS = "digests"

# Bytes of the files of one prefix whose lines are dealt to one part before they are written.
PART_BYTES = 32 * 1024 * 1024

# Per dataset the places its files may be in, each a root and a file pattern.
Inputs = Mapping[str, Sequence[tuple[str, str]]]


def list_inputs(spark: SparkSession, inputs: Inputs) -> DataFrame:
    """Listing of all datasets; each takes the first of its ``(root, pattern)`` with files."""
    listings = [first_available(spark, name, places) for name, places in inputs.items()]
    return reduce(DataFrame.unionByName, listings)


def _raw_lines(spark: SparkSession, files: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The raw lines of some listed datasets, by name."""
    places = files.select("dataset", "root", "pattern").distinct().where(F.col("dataset").isin(*names)).collect()
    found = {}
    for place in places:
        lines = read_lines(spark, place["root"], pattern=place["pattern"], position=True, raw=True)
        found[place["dataset"]] = lines.withColumn("dataset", F.lit(place["dataset"]))
    return found


def with_digests(files: DataFrame, digests: DataFrame) -> DataFrame:
    """Listed files with ``lines``, ``open_end`` and ``digest``; an empty file has no lines.

    A file's last line has no end where the bytes of its lines, each with an end, are one more than the file's.
    """
    joined = files.drop("lines", "open_end", "digest").join(digests.drop("bytes"), ["dataset", "path"], "left")
    joined = joined.join(digests.select("dataset", "path", "bytes"), ["dataset", "path"], "left")
    open_end = F.col("bytes") == F.col("length") + 1
    return joined.withColumns(
        {
            "lines": F.coalesce("lines", F.lit(0)),
            "open_end": F.coalesce(open_end, F.lit(False)),
            "digest": F.coalesce("digest", F.lit("0")),
        }
    ).drop("bytes")


def source_files(
    spark: SparkSession, inputs: Inputs, names: Sequence[str], *, known: DataFrame | None = None
) -> DataFrame:
    """Listing of the text datasets ``names`` with the digest of every file's content.

    Files that ``known``, an earlier listing with digests, has with the same length and time are not read
    again.
    """
    files = list_inputs(spark, {name: inputs[name] for name in names})
    if known is None:
        lines = reduce(DataFrame.unionByName, _raw_lines(spark, files, names).values())
        return with_digests(files, file_digests(lines))
    # An empty file has no time.
    time = F.coalesce(F.col("modificationTime").cast("string"), F.lit(""))
    state = F.concat_ws("\n", "dataset", "path", F.col("length").cast("string"), time)
    files, known = files.withColumn("state", state), known.withColumn("state", state)
    old = files.join(known.select("state", "lines", "open_end", "digest"), "state").drop("state")
    new = files.join(known.select("state"), "state", "left_anti").drop("state")
    if new.isEmpty():
        return old
    lines = reduce(DataFrame.unionByName, [of_paths(lines, new) for lines in _raw_lines(spark, new, names).values()])
    return with_digests(new, file_digests(lines)).unionByName(old)


def _dealt(lines: DataFrame, files: DataFrame, prefix_length: int) -> DataFrame:
    """Lines dealt by dataset and prefix, those of a prefix of over ``PART_BYTES`` to a task for as many bytes."""
    key = ["dataset", "prefix"]
    prefix = F.substring(base_name("path"), 1, prefix_length).alias("prefix")
    parts = F.ceil(F.sum("length") / PART_BYTES).cast("int")
    large = files.groupBy("dataset", prefix).agg(parts.alias("_parts")).where("_parts > 1")
    joined = lines.join(F.broadcast(large), key, "left")
    part = F.pmod(F.xxhash64("file_path", "row_id"), F.coalesce("_parts", F.lit(1)))
    return joined.withColumn("_part", part).repartition(*key, "_part").select(*lines.columns)


def land_raw(
    spark: SparkSession,
    inputs: Inputs,
    raw_root: str,
    *,
    text_datasets: Sequence[str],
    required: Sequence[str] = (),
    prefix_length: int = 0,
) -> DataFrame:
    """Land text inputs line by line and list every input file; returns the stored listing.

    The inputs are listed once; the stored listing says which files are required, read and later
    compared. Lines are cut at line feeds and keep all other bytes, so files of any content come back
    byte for byte (``landed_bytes``). They are written by the tasks that read them, without a shuffle, so neither a large
    file nor a large dataset gathers in one task. With ``prefix_length`` the lines are also
    partitioned by the first characters of the file name, which lets later scans of few stations
    skip the rest; they are then dealt by prefix, and a prefix with many bytes in parts, so that a folder
    gets few files and a prefix with most of the lines is still written by several tasks.

    The digests of what was landed are stored beside the lines (``DIGESTS``).
    """
    write_layer(list_inputs(spark, inputs), raw_root, FILES)
    stored = read_layer(spark, raw_root, FILES)
    require_inputs(stored, required)
    partitions = ["dataset", "prefix"] if prefix_length else ["dataset"]
    texts = list(_raw_lines(spark, stored, text_datasets).values()) if text_datasets else []
    if texts:
        landed = reduce(DataFrame.unionByName, texts)
        if prefix_length:
            landed = landed.withColumn("prefix", F.substring("file_name", 1, prefix_length))
            landed = _dealt(landed, stored.where(F.col("dataset").isin(*text_datasets)), prefix_length)
        write_layer(landed, raw_root, LINES, partition_by=partitions)
        digests = file_digests(read_layer(spark, raw_root, LINES))
        texts = stored.where(F.col("dataset").isin(*text_datasets))
        write_layer(with_digests(texts, digests), raw_root, DIGESTS)
    return stored.select(*schemas.MANIFEST.fieldNames())


def landed_lines(spark: SparkSession, raw_root: str, dataset: str) -> DataFrame:
    """Lines of one landed dataset, without line ends; other datasets' folders are not listed."""
    lines = read_layer(spark, raw_root, LINES).where(F.col("dataset") == dataset)
    return lines.withColumn("value", F.regexp_replace("value", "\r$", ""))


def landed_bytes(spark: SparkSession, raw_root: str, dataset: str) -> DataFrame:
    """``(relative_path, block_start, row_id, content)``: a landed dataset's files, a line a row, byte for byte.

    In order of the middle columns, ``content`` put together is the file.
    """
    lines = read_layer(spark, raw_root, LINES).where(F.col("dataset") == dataset)
    files = read_layer(spark, raw_root, DIGESTS).where(F.col("dataset") == dataset)
    last = F.struct("block_start", "row_id")
    open_files = files.where("open_end").select(F.col("path").alias("file_path"))
    ends = lines.join(open_files, "file_path", "left_semi").groupBy("file_path").agg(F.max(last).alias("last"))
    names = files.select(F.col("path").alias("file_path"), "relative_path")
    joined = lines.join(names, "file_path").join(ends, "file_path", "left")
    end = F.when(F.col("last") == last, b"").otherwise(b"\n")
    content = F.concat(F.col("value").cast("binary"), end)
    return joined.select("relative_path", "block_start", "row_id", content.alias("content"))


def landed_files(spark: SparkSession, raw_root: str) -> DataFrame:
    """Files whose lines were landed, with their lines, bytes and digest as they are stored now.

    Worked out from the stored lines themselves; only whether a file's last line has an end is taken from
    the landing.
    """
    now = file_digests(read_layer(spark, raw_root, LINES))
    stored = read_layer(spark, raw_root, DIGESTS).select("dataset", "path", "relative_path", "open_end")
    length = F.col("bytes") - F.col("open_end").cast("bigint")
    joined = stored.join(now, ["dataset", "path"], "left").where("lines is not null or not open_end")
    return joined.select(
        "dataset",
        "path",
        "relative_path",
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce(length, F.lit(0)).alias("length"),
        "open_end",
        F.coalesce("digest", F.lit("0")).alias("digest"),
    )


def reconcile_landing(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Text files against what was landed of them, by dataset and path below the input root.

    ``files`` as from ``source_files``, ``stored`` as from ``landed_files``; datasets that were not landed as
    text are left out. Files of equal size whose digests differ are ``content_differs``.
    """

    def keyed(listing: DataFrame) -> DataFrame:
        key = F.concat_ws("/", "dataset", "relative_path").alias("relative_path")
        return listing.select(key, "length", "digest")

    texts = files.join(stored.select("dataset").distinct(), "dataset", "left_semi")
    return reconcile(keyed(texts), keyed(stored), content="digest")


def landing_tree(files: DataFrame) -> DataFrame:
    """Folder digests of ``source_files`` or ``landed_files``, with a folder for every dataset."""
    return tree(files.withColumn("relative_path", F.concat_ws("/", "dataset", "relative_path")))
