"""Benchmark items in documents: fingerprints of item-sized windows, then exact similarity."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settle, text_or_empty

SHINGLE = 5
BITS = 64
BLOCKS = 8
# Bits in which one block of a near fingerprint may differ; with 8 blocks, any two fingerprints that
# differ in at most 8 * (2 + 1) - 1 bits have such a block.
BLOCK_RADIUS = 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
# A table of the benchmark is broadcast up to this many rows (of some 50 bytes), and shuffled beyond.
MAX_BROADCAST_ROWS = 500_000

WINDOW = ["doc_id", "text_hash", "start", "n_words"]


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{M}\\p{N}]+"), "")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def _shingle(words: str, at: str, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(F.col(words), F.col(at) + k) for k in range(length)])


def _weight(words: str, at: str, length: int) -> Column:
    """Characters of a shingle's words: long words say more than short ones."""
    return F.length(F.array_join(F.slice(F.col(words), F.col(at) + 1, F.lit(length)), "")).cast("long")


def _shingles(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """``hash``, ``weight`` and ``count`` of the distinct shingles of each row's ``words``.

    ``lengths`` are the shingle lengths in use; a row has its own in ``length``.
    """
    places = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    rows = df.where(F.size("words") >= F.col("length")).select(*keys, "words", "length", F.explode(places).alias("at"))
    hashed = F.coalesce(*[F.when(F.col("length") == k, _shingle("words", "at", k)) for k in lengths])
    weighed = F.coalesce(*[F.when(F.col("length") == k, _weight("words", "at", k)) for k in lengths])
    rows = rows.select(*keys, hashed.alias("hash"), weighed.alias("weight"))
    return rows.groupBy(*keys, "hash").agg(F.first("weight").alias("weight"), F.count(F.lit(1)).alias("count"))


def _fingerprints(shingles: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash: a bit is set where the shingles that have it weigh over half of all."""
    mass = F.col("weight") * F.col("count")
    bits = [
        F.sum(F.when(F.shiftright("hash", bit).bitwiseAND(F.lit(1)) == 1, mass).otherwise(-mass)).alias(f"b{bit}")
        for bit in range(BITS)
    ]
    sums = shingles.groupBy(*keys).agg(F.sum(mass).alias("mass"), *bits)
    fingerprint = F.lit(0).cast("long")
    for bit in range(BITS):
        fingerprint = fingerprint.bitwiseOR(F.when(F.col(f"b{bit}") > 0, F.shiftleft(F.lit(1).cast("long"), bit)).otherwise(F.lit(0).cast("long")))
    return sums.select(*keys, "mass", fingerprint.alias("fingerprint"))


def _blocks(df: DataFrame, masks: list[int]) -> DataFrame:
    """A row for each block of the fingerprint and each mask of bits turned over in it."""
    width = BITS // BLOCKS
    blocks = F.array(
        *[
            F.struct(
                F.lit(block).alias("block"),
                F.shiftright("fingerprint", block * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int").alias("value"),
            )
            for block in range(BLOCKS)
        ]
    )
    rows = df.withColumn("_block", F.explode(blocks))
    if masks != [0]:
        rows = rows.withColumn("_mask", F.explode(F.array(*map(F.lit, masks))))
    else:
        rows = rows.withColumn("_mask", F.lit(0))
    value = F.col("_block.value").bitwiseXOR(F.col("_mask"))
    return rows.withColumn("block", F.col("_block.block")).withColumn("value", value).drop("_block", "_mask")


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    threshold: float = 0.75,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Benchmark items that a window of a document's words repeats, one row per document and item.

    Windows have as many words as the item, are cut at the end of the text, and start at every place
    from which they hold shingles of one item that weigh ``threshold`` of it (with less they cannot
    reach that similarity). Each window and each item has a 64-bit SimHash of its
    weighted shingles. Items are found through an index of 8 blocks of their fingerprints, each with
    up to 2 bits turned over, which meets every item within ``radius`` (23) bits. Candidates are then
    held to the exact similarity: the weights common to both multisets of shingles over the weights of
    either, at least ``threshold``.

    Returns ``doc_id, item_id, start, n_words, hamming, similarity`` of the best window (the first of
    equals). Texts under five words are one shingle. NULL texts have no words and match nothing; items
    without words are left out; equal items are each reported; rows that repeat a document count once;
    documents under a NULL id are reported under it.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the index holds for a radius of at most {RADIUS}")
    items = benchmark.select(F.col(item_id_col).alias("item_id"), words_of(text_or_empty(item_text_col)).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("n_words", F.size("words"))
    items = settle(items.withColumn("length", F.least(F.size("words"), F.lit(SHINGLE))).distinct(), "items")
    lengths = sorted(row["length"] for row in items.select("length").distinct().collect()) or [SHINGLE]

    item_shingles = settle(_shingles(items, ["item_id", "n_words"], lengths), "item-counts")
    mass = F.sum(F.col("weight") * F.col("count")).over(Window.partitionBy("item_id", "n_words"))
    known = item_shingles.withColumn("least", threshold * mass).withColumn("length", F.least("n_words", F.lit(SHINGLE)))
    known = settle(known.drop("count"), "item-shingles")

    text = text_or_empty(text_col)
    split = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    hits = None
    for length in lengths:
        rows = split.where(F.size("words") >= length)
        rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - length)))
        rows = rows.withColumn("hash", _shingle("words", "at", length))
        theirs = _small(known.where(F.col("length") == length), known.count())
        # Every window that holds the place lies in the words from `first` to the item's length after it.
        first = F.greatest(F.col("at") - F.col("n_words") + length, F.lit(0))
        rows = rows.join(theirs, "hash").withColumn("first", first)
        around = F.slice("words", F.col("first") + 1, F.col("at") - F.col("first") + F.col("n_words"))
        rows = rows.select("doc_id", "text_hash", "n_words", "item_id", "at", "first", "length", "weight", "least", around.alias("around"))
        hits = rows if hits is None else hits.unionByName(rows)
    hits = settle(hits, "hits")
    starts = hits.drop("around").distinct().withColumn("start", F.explode(F.sequence("first", "at")))
    starts = starts.groupBy(*WINDOW, "item_id", "length").agg(
        F.sum("weight").alias("held"), F.first("least").alias("least"), F.min("at").alias("at")
    )
    # Sums of doubles aside, a window at the threshold itself stays.
    starts = starts.where(F.col("held") >= F.col("least") - 1e-6)
    starts = starts.groupBy(*WINDOW, "length").agg(F.min("at").alias("at"))
    around = hits.select("text_hash", "n_words", "at", "first", "around").dropDuplicates(["text_hash", "n_words", "at"])
    windows = starts.join(around, ["text_hash", "n_words", "at"])
    held = F.slice("around", F.col("start") - F.col("first") + 1, F.col("n_words"))
    windows = windows.select(*WINDOW, "length", held.alias("words"))
    windows = settle(_shingles(windows, WINDOW, lengths), "window-shingles")

    masks = [sum(1 << bit for bit in bits) for n in range(BLOCK_RADIUS + 1) for bits in combinations(range(BITS // BLOCKS), n)]
    index = _blocks(_fingerprints(item_shingles, ["item_id", "n_words"]), masks)
    index = settle(index.withColumnsRenamed({"fingerprint": "item_fingerprint", "mass": "item_mass"}), "item-index")
    probes = _blocks(_fingerprints(windows, WINDOW), [0])
    hamming = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    near = probes.join(_small(index, index.count()), ["n_words", "block", "value"]).withColumn("hamming", hamming)
    near = near.where(F.col("hamming") <= radius).select(*WINDOW, "item_id", "mass", "item_mass", "hamming").distinct()

    theirs = item_shingles.select("item_id", "n_words", "hash", F.col("count").alias("item_count"))
    both = windows.join(_small(theirs, item_shingles.count()), ["n_words", "hash"])
    common = F.sum(F.col("weight") * F.least("count", "item_count")).alias("common")
    shared = both.groupBy(*WINDOW, "item_id").agg(common)
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*WINDOW, "item_id"]]
    joined = near.alias("n").join(shared.alias("s"), same)
    similarity = F.col("s.common") / (F.col("n.mass") + F.col("n.item_mass") - F.col("s.common"))
    found = joined.select(*[f"n.{c}" for c in [*WINDOW, "item_id", "hamming"]], similarity.alias("similarity"))
    found = found.where(F.col("similarity") >= threshold)
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct("similarity", -F.col("start")))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("best"))
    return found.select("doc_id", "item_id", "best.*")


def without_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents in which no benchmark item is found; rows without an id stay where clean."""
    found = find_items(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.col(id_col).eqNullSafe(F.col("_found")), "left_anti")
