"""Hard negatives by exact inner products, worked out in a residue number system.

Vectors are scaled to integers. Their inner products are taken modulo several small primes in float32,
where every sum stays below 2**24 and so is exact, and put together by Chinese remaindering.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settle

# Components that one float32 product sums up, and the integers float32 holds without a gap.
SEGMENT = 64
EXACT = 2**24
# Scores have to stay below this, so that a hundred times a score is still a long.
MOST = 2**56
# Components of all anchors that go to the tasks at once; more anchors take more passes.
BATCH = 2_000_000
ANCHORS, ROWS = 256, 4_096
CROWD = 8

Arrays = list[np.ndarray]


def moduli(bound: int) -> list[int]:
    """Primes whose product is over twice ``bound``, none too large for exact float32 sums."""
    chosen, candidate = [], 2 * math.isqrt(EXACT // SEGMENT) + 1
    while math.prod(chosen) <= 2 * bound:
        if all(candidate % k for k in range(2, math.isqrt(candidate) + 1)):
            chosen.append(candidate)
        candidate -= 1
    return chosen


def _centred(values: np.ndarray, p: int) -> np.ndarray:
    return values - p * np.rint(values / p)


def residues(matrix: np.ndarray, primes: list[int]) -> Arrays:
    """The matrix modulo each prime, between -p/2 and p/2, in float32."""
    found = []
    for p in primes:
        rest = matrix % p
        found.append((rest - p * (rest > p // 2)).astype(np.float32))
    return found


def products(one: Arrays, other: Arrays, primes: list[int]) -> np.ndarray:
    """All inner products of the rows of two matrices, from their residues.

    Every residue of a product gives one digit of it in the mixed base of the primes; as digits lie
    around 0, so do the products.
    """
    digits: Arrays = []
    for k, p in enumerate(primes):
        value = np.zeros((len(one[k]), len(other[k])))
        for at in range(0, one[k].shape[1], SEGMENT):
            value += one[k][:, at : at + SEGMENT] @ other[k][:, at : at + SEGMENT].T
        value = _centred(value, p)
        for digit, q in zip(digits, primes):
            value = _centred((value - digit) * pow(q, -1, p), p)
        digits.append(value)
    total = np.zeros(digits[0].shape, dtype=np.int64)
    for digit, p in zip(reversed(digits), reversed(primes)):
        total = total * p + digit.astype(np.int64)
    return total


class Best:
    """The best ``keep`` rows of each of ``n`` anchors so far, by score, then id (none last), then row."""

    def __init__(self, n: int, keep: int):
        self.n, self.keep = n, keep
        self.floor = np.full(n, np.iinfo(np.int64).min)
        self.found: Arrays = [np.zeros(0, dtype=np.int64) for _ in range(5)]

    def add(self, new: Arrays) -> None:
        at, score, nameless, ids, row = merged = [np.concatenate(pair) for pair in zip(self.found, new)]
        order = np.lexsort((row, ids, nameless, -score, at))
        ordered = at[order]
        rank = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
        self.found = [column[order[rank < self.keep]] for column in merged]
        counts = np.bincount(self.found[0], minlength=self.n)
        full = counts == self.keep
        self.floor[full] = self.found[1][np.cumsum(counts)[full] - 1]


@dataclass
class Asked:
    """Anchors and the scores asked for, a window a column: ``low <= score <= high``."""

    row: np.ndarray
    label: np.ndarray
    matrix: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _padded(column: pa.Array, dim: int) -> np.ndarray:
    """The lists as rows of a matrix, shorter ones filled up with 0."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy().astype(np.int64)
    if (sizes == dim).all():
        return values.reshape(-1, dim)
    matrix = np.zeros((len(sizes), dim), dtype=np.int64)
    matrix[np.arange(dim) < sizes[:, None]] = values
    return matrix


def _gather(rows: DataFrame, asked: Asked, *, alike: bool, keep: int, primes: list[int], dim: int) -> DataFrame:
    """The best ``keep`` rows of every partition for every anchor and window, of its label or of others."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        # anchors in order of label, so that a tile looks at few labels
        order = np.argsort(asked.label, kind="stable")
        tiles = [order[i : i + ANCHORS] for i in range(0, len(order), ANCHORS)]
        sides = [residues(asked.matrix[tile], primes) for tile in tiles]
        windows = range(asked.low.shape[1])
        best = [[Best(len(tile), keep) for _ in windows] for tile in tiles]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                labels, row = part["label"].to_numpy(), part["row"].to_numpy()
                nameless = part["id"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = part["id"].fill_null(0).to_numpy()
                matrix = residues(_padded(part["vector"], dim), primes)
                for tile, side, bests in zip(tiles, sides, best):
                    of_tile = np.isin(labels, asked.label[tile])
                    near = np.flatnonzero(of_tile) if alike else np.arange(len(labels))
                    if not len(near):
                        continue
                    score = products(side, [m[near] for m in matrix], primes)
                    same = asked.label[tile][:, None] == labels[near]
                    allowed = same & (asked.row[tile][:, None] != row[near]) if alike else ~same
                    for w in windows:
                        least = np.maximum(asked.low[tile, w], bests[w].floor)[:, None]
                        reach = allowed & (score >= least) & (score <= asked.high[tile, w][:, None])
                        if reach.sum() > CROWD * keep * len(tile):
                            # what is below the best of this part alone cannot come in
                            worst = np.where(reach, -score, np.iinfo(np.int64).max)
                            reach &= -score <= np.partition(worst, keep - 1, axis=1)[:, keep - 1 : keep]
                        at, column = np.nonzero(reach)
                        if len(at):
                            place = near[column]
                            bests[w].add([at, score[at, column], nameless[place], ids[place], row[place]])
        for tile, bests in zip(tiles, best):
            for w, one in enumerate(bests):
                at, score, nameless, ids, row = one.found
                if len(at):
                    yield pa.record_batch(
                        {
                            "anchor": pa.array(tile[at]),
                            "window": pa.array(np.full(len(at), w)),
                            "score": pa.array(score),
                            "id": pa.array(ids, mask=nameless.astype(bool)),
                            "row": pa.array(row),
                        }
                    )

    found = rows.mapInArrow(run, "anchor bigint, window bigint, score bigint, id bigint, row bigint")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(
    vectors: DataFrame,
    anchors: Column,
    *,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    batch: int = BATCH,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """The best rows of other labels for every anchor and each of its positives, within a window of scores.

    ``anchors`` is a condition on ``vectors``. Components become ``floor(scale * x)`` and a score is an
    exact integer inner product. The positives of an anchor are its first other rows of the same label;
    for each, the first rows of other labels are returned whose score lies between ``low`` and ``high``
    per cent of the positive's. Higher scores come first, then smaller ids; rows without an id follow.

    Anchors are taken in passes of bounded size, and only a pass's anchors go to the tasks; the other
    rows are never shuffled. A task keeps the best rows of its partition, which a window then ranks.

    A row with a NULL label or vector or with a component that is NULL or not finite takes no part. A row
    given twice counts once; rows that share an id but differ otherwise are rows of their own. Of vectors
    of different lengths the shorter counts as filled up with zeros. A negative positive's window is
    empty. Other columns play no part. An empty table and one without anchors give no rows. Components so
    large that a score could reach 2**56 are refused with a ``ValueError``.
    """
    spark = vectors.sparkSession
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        whole.alias("whole"),
    )
    rows = rows.where(F.col("label").isNotNull() & F.col("whole")).drop("whole").distinct()
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    most = rows.agg(
        F.max(F.size("vector")).alias("dim"),
        F.max(F.greatest(-F.array_min("vector"), F.array_max("vector"))).alias("most"),
        F.min(F.array_min("vector")).alias("least"),
        F.count_if("anchor").alias("anchors"),
    ).first()
    dim, largest = most["dim"] or 0, max(most["most"] or 0, -(most["least"] or 0))
    if not most["anchors"]:
        return spark.createDataFrame([], RESULT)
    bound = max(1, dim * largest**2)
    if bound >= MOST:
        raise ValueError(f"components of up to {largest} in {dim} dimensions make scores that are too large")
    primes, dim = moduli(bound), max(dim, 1)
    passes = math.ceil(most["anchors"] * dim / batch)

    def of_pass(k: int) -> DataFrame:
        chosen = rows.where(F.col("anchor") & (F.pmod(F.xxhash64("row"), F.lit(passes)) == k)).toArrow().combine_chunks()
        n = chosen.num_rows
        if not n:
            return spark.createDataFrame([], RESULT)
        vector = chosen["vector"].combine_chunks() if isinstance(chosen["vector"], pa.ChunkedArray) else chosen["vector"]
        limit = np.iinfo(np.int64).max
        asked = Asked(
            chosen["row"].to_numpy(),
            chosen["label"].to_numpy(),
            _padded(vector, dim),
            np.full((n, 1), -limit),
            np.full((n, 1), limit),
        )
        found = _gather(rows, asked, alike=True, keep=positives, primes=primes, dim=dim).toArrow()
        scores = found["score"].to_numpy()
        asked.low, asked.high = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
        place = (found["anchor"].to_numpy(), found["rank"].to_numpy() - 1)
        asked.low[place], asked.high[place] = -(-low * scores // 100), high * scores // 100
        pairs = pa.table(
            {
                "anchor": found["anchor"],
                "window": pa.array(place[1].astype(np.int64)),
                "anchor_id": chosen["id"].take(found["anchor"]),
                "positive_id": found["id"],
                "positive_score": found["score"],
            }
        )
        ranked = _gather(rows, asked, alike=False, keep=negatives, primes=primes, dim=dim)
        result = ranked.join(spark.createDataFrame(pairs), ["anchor", "window"]).select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        return settle(result, "negatives") if passes > 1 else result

    return reduce(DataFrame.unionByName, [of_pass(k) for k in range(passes)])
