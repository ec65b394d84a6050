"""Near-duplicate documents by an LSH forest over MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle, text_or_empty

SHINGLE = 5
SIGNATURE = 64
TREES = 16
# Values of a tree's order that a region's documents have in common, from broad regions down to those
# whose documents agree in the whole signature.
DEPTHS = (2, 4, 8, 16, SIGNATURE)
# A region with more documents is looked at one depth further down.
REGION = 32
# Share of equal signature values under which a pair is not compared in full; at 64 values a pair at
# the similarity wanted, 0.75, falls below it about once in a million.
LEAST_AGREEMENT = 0.5
# Index and probe rows of one shingle that meet in one group of a join.
HOT = 1_000
NO_ID = -(2**63)

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_DRAWN = np.random.default_rng(20_240_229)
FACTORS = _DRAWN.integers(1, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _DRAWN.integers(0, 2**63, SIGNATURE, dtype=np.uint64)
PLACES = _DRAWN.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = "id long, n_shingles long, set_a long, set_b long, signature binary"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles; of a shorter text as a whole.

    A-Z count as a-z; words end at space, tab and the line breaks 0A to 0D.
    """
    words = text.encode().translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(word) for word in words], np.uint64)
    length = min(SHINGLE, len(hashes))
    count = len(hashes) - length + 1
    with np.errstate(over="ignore"):
        mixed = np.full(count, length, np.uint64)
        for k in range(length):
            mixed = _mixed(mixed + hashes[k : k + count] * PLACES[k])
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least of each of ``SIGNATURE`` orders of the shingles, as 32-bit values."""
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(hashes), 4096):
            part = hashes[start : start + 4096, None] * FACTORS + OFFSETS
            least = np.minimum(least, part.min(axis=0))
    return (least >> np.uint64(32)).astype(">u4")


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value in batch["text"]:
            found = shingles(value.as_py())
            digest = xxhash.xxh3_128_intdigest(found.tobytes())
            values = signature(found).tobytes() if len(found) else None
            rows.append((len(found), digest >> 64, digest & (2**64 - 1), values))
        sizes, a, b, signatures = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.record_batch(
            {
                "id": batch["id"],
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_a": pa.array(np.array(a, np.uint64).view(np.int64)),
                "set_b": pa.array(np.array(b, np.uint64).view(np.int64)),
                "signature": pa.array(signatures, pa.binary()),
            }
        )


ROWS = "id long, " + ", ".join(f"p{depth} long" for depth in DEPTHS)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each tree the hashes of the beginnings of a document's values in the tree's order.

    A tree reads the signature from a place of its own on, round and round, so that the beginnings of
    all trees together use every value once before any is used again.
    """
    step, width = 4 * SIGNATURE // TREES, 4
    for batch in batches:
        ids, columns = [], [[] for _ in DEPTHS]
        for doc, value in zip(batch["id"].to_pylist(), batch["signature"], strict=True):
            twice = value.as_py() * 2
            for tree in range(TREES):
                ids.append(doc)
                for column, depth in zip(columns, DEPTHS, strict=True):
                    start = tree * step
                    column.append(xxhash.xxh3_64_intdigest(twice[start : start + width * depth], seed=tree))
        arrays = {f"p{d}": pa.array(np.array(c, np.uint64).view(np.int64)) for d, c in zip(DEPTHS, columns, strict=True)}
        yield pa.record_batch({"id": pa.array(ids, pa.int64())} | arrays)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for i, (x, y) in enumerate(zip(batch["of_a"], batch["of_b"], strict=True)):
            same = np.frombuffer(x.as_py(), ">u4") == np.frombuffer(y.as_py(), ">u4")
            if same.mean() >= LEAST_AGREEMENT:
                kept.append(i)
        yield pa.record_batch({name: batch[name] for name in ("a", "b")}).take(pa.array(kept, pa.int64()))


def _alike(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (x, y) in enumerate(zip(batch["of_a"], batch["of_b"], strict=True)):
                x, y = shingles(x.as_py()), shingles(y.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= threshold * (len(x) + len(y) - common):
                    kept.append(i)
            yield pa.record_batch({name: batch[name] for name in ("a", "b")}).take(pa.array(kept, pa.int64()))

    return run


def _joined(pairs: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``a, b`` with what each has in the column ``name``.

    The joins are merged, whatever the sizes: what is joined grows with the corpus, so a plan that
    broadcasts the pairs of a small one would not be the plan of a large one.
    """
    left = values.select(F.col("id").alias("a"), F.col(name).alias("of_a"))
    right = values.select(F.col("id").alias("b"), F.col(name).alias("of_b"))
    whole = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return whole.select("a", "b", "of_a", "of_b")


def _regions(forest: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of documents with the first one of their region, the regions of each document, and the
    documents of broadest regions with over ``REGION`` of them.

    Every document starts in the broadest regions of its trees. A region with over ``REGION``
    documents is taken apart one depth further down. At the last depth, whatever its size, each is
    paired with the first and the last one only: documents with equal signatures that are not linked
    to the same one are less likely than any other miss. Sizes come from partial aggregates, and the rows
    of a large region are spread over tasks by the join that brings its size back.
    """
    pairs, regions, rows, crowd = [], [], forest, None
    for depth in DEPTHS:
        key, last = f"p{depth}", depth == DEPTHS[-1]
        sizes = rows.groupBy(key).agg(
            F.count(F.lit(1)).alias("size"), F.min("id").alias("first"), F.max("id").alias("last")
        )
        rows = rows.join(sizes.where("size > 1"), key)
        deeper = [f"p{d}" for d in DEPTHS if d > depth]
        rows = settle(rows.select("id", key, *deeper, "size", "first", "last"), f"regions-{depth}")
        crowd = rows.where(F.col("size") > REGION).select("id").distinct() if crowd is None else crowd
        pairs.append(rows.where("id > first").select(F.col("first").alias("a"), F.col("id").alias("b")))
        small = rows if last else rows.where(F.col("size") <= REGION)
        regions.append(small.select("id", F.col(key).alias("region"), "size"))
        if last:
            pairs.append(rows.where("id < last").select(F.col("id").alias("a"), F.col("last").alias("b")))
        rows = rows.where(F.col("size") > REGION).select("id", *deeper)
    for more in (pairs, regions):
        for part in more[1:]:
            more[0] = more[0].unionByName(part)
    return pairs[0].distinct(), regions[0], crowd


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(value.as_py()).view(np.int64) for value in batch["text"]]
        yield pa.record_batch(
            {
                "id": batch["id"],
                "component": batch["component"],
                "n": pa.array([len(values) for values in found], pa.int64()),
                "shingles": pa.array(found, pa.list_(pa.int64())),
            }
        )


def _crowd_pairs(texts: DataFrame, threshold: int) -> DataFrame:
    """Every pair ``a, b`` of different components in ``id, component, text`` that may reach ``threshold``.

    Prefix filtering, which loses no pair: shingles are put in one order, those of a single component
    first (no pair wanted shares them), then from rare to common. Sets that are alike enough have their
    first common shingle where the rest of both still holds the overlap that the threshold asks for. So
    a set meets larger ones by the beginning that leaves room for one of its own size, and smaller
    ones by the longer beginning that leaves room for the smallest that can be alike. What a whole crowd
    has in common stands at the end and is in neither where its members are too far from each other.
    Common shingles are cut in groups of ``HOT`` rows on either side, each pair of groups by itself.
    """
    spread = settle(texts.mapInArrow(_spread, "id long, component long, n long, shingles array<long>"), "crowd")
    rows = spread.select("id", "component", "n", F.explode("shingles").alias("shingle"))
    several = [F.count(F.lit(1)).alias("among"), F.min("component").alias("x"), F.max("component").alias("y")]
    shared = rows.groupBy("shingle").agg(*several).where("x != y").select("shingle", "among")
    rows = rows.join(shared.hint("merge"), "shingle").groupBy("id", "component", "n")
    rows = rows.agg(F.array_sort(F.collect_list(F.struct("among", "shingle"))).alias("order"))
    left = F.size("order") - F.col("pos")  # shingles of the set from this place on
    rows = rows.select("id", "component", "n", "order", F.posexplode("order"))
    rows = rows.where(100 * left >= threshold * F.col("n"))
    rows = rows.withColumn("left", left.cast("long")).withColumn("first", (100 + threshold) * left >= 2 * threshold * F.col("n"))
    rows = settle(rows.select("id", "component", "n", F.col("col.shingle").alias("shingle"), "left", "first"), "beginnings")

    sizes = rows.groupBy("shingle").agg(F.count_if("first").alias("ones"), *several).where("ones > 0 and x != y")
    groups = {name: F.ceil(F.col(name) / HOT).cast("int") for name in ("ones", "among")}
    sizes = sizes.select("shingle", groups["ones"].alias("ones"), groups["among"].alias("twos"))
    rows = settle(rows.join(sizes.hint("merge"), "shingle"), "meetings")
    drawn = F.xxhash64("id")

    def side(some: DataFrame, own: str, other: str, suffix: str) -> DataFrame:
        columns = [F.col(name).alias(f"{name}_{suffix}") for name in ("id", "component", "n", "left")]
        group = [F.pmod(drawn, own).cast("int").alias(f"of_{own}"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"of_{other}")]
        return some.select("shingle", *columns, *group)

    one, two = side(rows.where("first"), "ones", "twos", "a"), side(rows, "twos", "ones", "b")
    met = one.hint("merge").join(two, ["shingle", "of_ones", "of_twos"])
    met = met.where("component_a != component_b and (n_a < n_b or (n_a = n_b and id_a < id_b))")
    met = met.where(f"{100 + threshold} * least(left_a, left_b) >= {threshold} * (n_a + n_b)")
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the least id reachable over links ``a, b``, for every id that has a link.

    Each round a node takes the least label next to it and then the label of its label, so labels
    cross a component in a number of rounds that grows with the logarithm of its width.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id"))
        least = near.agg(F.min("component").alias("near"))
        hooked = labels.join(least, "id").select("id", "component", F.least("component", "near").alias("next"))
        ahead = labels.select(F.col("id").alias("next"), F.col("component").alias("beyond"))
        jumped = hooked.join(ahead, "next", "left").select(
            "id", F.least("next", "beyond").alias("component"), (F.least("next", "beyond") != F.col("component")).alias("moved")
        )
        jumped = settle(jumped, "labels")
        labels = jumped.select("id", "component")
        if jumped.where("moved").isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame,
    *,
    threshold: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Components of documents whose shingle sets share ``threshold`` percent of their union.

    1. Every text becomes its set of five-word shingles and a MinHash signature. Documents with equal
       sets are one class, and only the least of them goes on.
    2. The LSH forest: ``TREES`` orders of the signature. Documents with a common beginning form a
       region, as deep as it takes to have at most ``REGION`` of them. Each is paired with the first of
       its regions at every depth on the way.
    3. Pairs whose signatures agree enough are compared on their full sets, which makes links.
    4. Documents that share a region and are still in different components are paired with each other
       and compared in the same way, so the links of a region are whole, not only those to its first.
    5. Documents whose broadest region in some tree has over ``REGION`` of them are a crowd. All pairs
       of it that may be alike and are still in different components are found by prefix filtering,
       which is exact, and compared.

    Returns ``doc_id, n_shingles, component_id, kept``: the least id reachable, and whether it is the
    row's own. A text without words, NULL or not, has no shingles and stands alone. A NULL id counts as
    the least. Rows that repeat an id are one document, kept or not together.
    """
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")
    texts = docs.select(ids, text_or_empty(text_col).alias("text"))
    signed = settle(texts.mapInArrow(_sign, SIGNED), "signatures")
    sets = ["set_a", "set_b"]
    worded = signed.where("n_shingles > 0")
    classes = worded.groupBy(*sets).agg(F.min("id").alias("id"), F.first("signature").alias("signature"))
    classes = settle(classes, "classes")
    pairs, regions, crowd = _regions(classes.select("id", "signature").mapInArrow(_grow, ROWS))
    regions = settle(regions.distinct(), "regions")
    pairs = settle(pairs, "pairs")

    # A document may be paired at the top of its trees and end alone in each, so both tables count.
    known = regions.select("id").unionByName(pairs.select(F.col("a").alias("id")))
    known = known.unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    signatures = settle(classes.join(known, "id", "left_semi").select("id", "signature"), "candidates")
    compared = texts.join(known.hint("merge"), "id", "left_semi").dropDuplicates(["id"])
    compared = settle(compared, "compared-texts")

    def links_among(some: DataFrame) -> DataFrame:
        agreeing = _joined(some, signatures, "signature").mapInArrow(_agreeing, "a long, b long")
        return settle(_joined(agreeing, compared, "text").mapInArrow(_alike(threshold), "a long, b long"), "verified")

    links = links_among(pairs)
    found = components(links)
    placed = regions.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    placed = placed.join(mixed.where("x != y").select("region"), "region", "left_semi").where(F.col("size") <= REGION)
    one = placed.select("region", F.col("id").alias("a"), F.col("component").alias("of_a"))
    two = placed.select("region", F.col("id").alias("b"), F.col("component").alias("of_b"))
    across = one.join(two, "region").where((F.col("a") < F.col("b")) & (F.col("of_a") != F.col("of_b")))
    across = across.select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    links = links.unionByName(links_among(across))
    found = components(links)
    if not crowd.isEmpty():
        held = compared.join(crowd.hint("merge"), "id").join(found.hint("merge"), "id", "left")
        held = held.select("id", F.coalesce("component", "id").alias("component"), "text")
        found = components(links.unionByName(links_among(settle(_crowd_pairs(held, threshold), "crowd-pairs"))))

    own = classes.join(found, "id", "left").select(*sets, F.coalesce("component", "id").alias("component"))
    result = signed.join(own, sets, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("id"))
    return result.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )


def without_duplicates(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of the least id of each component; rows that repeat that id stay together."""
    found = near_duplicates(docs, id_col=id_col, **options)
    kept = found.where("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_kept")).distinct()
    return docs.join(kept, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)) == F.col("_kept"), "left_semi")
