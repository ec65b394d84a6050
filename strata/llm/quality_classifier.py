"""Quality by the votes of the nearest labelled documents in a latent semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle, text_or_empty

# Labelled documents that vote, at most; beyond it a hash of the id chooses.
MAX_LABELLED = 6_000
# Terms are told apart by a hash; the space they are reduced to; rounds that find it.
BUCKETS = 4_096
DIMENSIONS = 48
ROUNDS = 4
NEIGHBOURS = 15
# Tasks that sum up the labelled rows, whose number is bounded.
TASKS = 8
# The votes' weight is the cosine to this power; cosines this close count as equal.
SHARPNESS = 16
ALIKE = 1e-6
BLOCK = 256

# Bytes of texts that are looked at together.
PIECE = 4_000_000

# The kind of each byte: blanks, lower and upper case, digits, bytes of other letters, and every mark by itself.
BLANK, LOWER, UPPER, DIGIT = 0, 1, 2, 3
KINDS = np.arange(256, dtype=np.uint64) + 4
KINDS[[9, 10, 11, 12, 13, 32]] = BLANK
KINDS[ord("a") : ord("z") + 1] = KINDS[128:] = LOWER
KINDS[ord("A") : ord("Z") + 1] = UPPER
KINDS[ord("0") : ord("9") + 1] = DIGIT
LOWERED = np.arange(256, dtype=np.uint64) + 1
LOWERED[ord("A") : ord("Z") + 1] += 32
SHAPE = 12

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Hashes to buckets, by the leading bits of a product."""
    mixed = (hashes + np.uint64(salt)) * _FACTOR
    mixed ^= mixed >> np.uint64(29)
    return (mixed * _FACTOR >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _hashes(values: np.ndarray, used: np.ndarray, starts: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A polynomial of each word's used values."""
    seen = np.cumsum(used)
    rank = seen - 1 - (seen[starts] - used[starts])[word]
    powers = np.cumprod(np.full(int(rank.max()) + 2, _FACTOR))
    return np.add.reduceat(np.where(used, values * powers[rank], np.uint64(0)), starts)


def _words(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every word of some bytes: its place, its hash, its shape's and its letters' hash, whether it has letters.

    ``begins`` are places at which a new text begins. A shape is the kinds of a word's bytes, runs as one, twelve
    at most: ``Word,`` and ``Other,`` have one shape.
    """
    kinds = KINDS[data]
    opens = np.r_[True, kinds[:-1] == BLANK]
    opens[begins[begins < len(data)]] = True
    at = np.flatnonzero(kinds != BLANK)
    if not len(at):
        return (at,) * 5
    kinds, opens, lowered = kinds[at], opens[at], LOWERED[data[at]]
    opens[0] = True
    starts = np.flatnonzero(opens)
    word = np.cumsum(opens) - 1
    whole = _hashes(data[at].astype(np.uint64) + np.uint64(1), np.ones(len(at), dtype=bool), starts, word)
    turns = opens.copy()
    turns[1:] |= kinds[1:] != kinds[:-1]
    n_turns = np.cumsum(turns)
    turns &= n_turns - n_turns[starts][word] < SHAPE
    shape = _hashes(kinds, turns, starts, word)
    letter = (kinds == LOWER) | (kinds == UPPER)
    letters = _hashes(lowered, letter, starts, word)
    return at[starts], whole, shape, letters, np.add.reduceat(letter.astype(np.int64), starts) > 0


def terms_of(texts: pa.Array) -> np.ndarray:
    """Shares of the terms of some texts, a row a text.

    Terms are words, shapes of words, words that repeat the one before, and the length. All bytes are looked at
    together; a run of over ``PIECE`` bytes without a blank counts as several words.
    """
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    counts, n = np.zeros(len(texts) * BUCKETS), np.zeros(len(texts), dtype=np.int64)
    start, last = 0, None
    while start < len(data):
        end = min(start + PIECE, len(data))
        if end < len(data):
            blanks = np.flatnonzero(KINDS[data[start:end]] == BLANK) + 1 + start
            ends = np.r_[blanks, offsets[(offsets > start) & (offsets <= end)]]
            end = int(ends.max()) if len(ends) else end
        begins = offsets[(offsets >= start) & (offsets < end)] - start
        at, whole, shape, letters, lettered = _words(data[start:end], begins)
        if len(at):
            text = np.searchsorted(offsets, at + start, side="right") - 1
            again = np.r_[last == (text[0], whole[0]), (whole[1:] == whole[:-1]) & (text[1:] == text[:-1])]
            last, row = (text[-1], whole[-1]), text * BUCKETS
            places = [row + _bucket(shape, 1), (row + _bucket(letters, 2))[lettered], row[again] + REPEATED]
            counts += np.bincount(np.concatenate(places), minlength=len(counts))
            n += np.bincount(text, minlength=len(n))
        start = end
    shares = counts.reshape(-1, BUCKETS) / np.maximum(n, 1)[:, None]
    shares[np.arange(len(texts)), LENGTHS[[int(size).bit_length() for size in n]]] += 1
    return shares


REPEATED = int(_bucket(np.zeros(1, dtype=np.uint64), 3)[0])
LENGTHS = _bucket(np.arange(64, dtype=np.uint64), 4)


@dataclass(frozen=True)
class Voters:
    """Rareness of terms, the axes of the space, and the labelled documents in it with their labels."""

    rareness: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    otherwise: float

    def place(self, texts: pa.Array) -> np.ndarray:
        """Texts as vectors of length 1 in the space, or 0 where none of their terms is in it."""
        return _unit((np.sqrt(terms_of(texts)) * self.rareness).astype(np.float32) @ self.axes)

    def votes(self, placed: np.ndarray) -> np.ndarray:
        """The labels of the nearest voters, weighted by similarity; those at a right angle or beyond have none.

        All voters that are as near as the last of the nearest vote as well.
        """
        cosines = placed @ self.vectors.T
        least = np.zeros((len(placed), 1), dtype=np.float32)
        if cosines.shape[1] > NEIGHBOURS:
            least = np.partition(cosines, -NEIGHBOURS, axis=1)[:, -NEIGHBOURS, None] - ALIKE
        text, voter = np.nonzero((cosines >= least) & (cosines > 0))
        weights = np.minimum(cosines[text, voter], 1).astype(np.float64) ** SHARPNESS
        total = np.bincount(text, weights, minlength=len(placed))
        known = total > 1e-9
        shares = np.bincount(text, weights * self.labels[voter], minlength=len(placed)) / np.where(known, total, 1)
        return np.where(known, np.clip(shares, 0, 1), self.otherwise)


def _unit(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(lengths > 1e-12, lengths, 1)).astype(np.float32)


def _documents_by_term(texts: DataFrame) -> np.ndarray:
    """How many documents hold a term, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for part in _blocks(batches):
            counts += (terms_of(part["text"]) > 0).sum(axis=0)
        used = np.flatnonzero(counts)
        yield pa.record_batch({"bucket": pa.array(used), "n": pa.array(counts[used])})

    summed = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS)
    counts[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _matrix(texts: pa.Array, rareness: np.ndarray) -> np.ndarray:
    """Texts as rows of weighted terms, of length 1."""
    matrix = np.sqrt(terms_of(texts)) * rareness
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(lengths > 0, lengths, 1)


def _axes(labelled: DataFrame, rareness: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors of the labelled documents' matrix, by subspace iteration.

    The tasks multiply and sum their rows; a matrix of ``BUCKETS`` x ``dimensions`` a task reaches the driver.
    """
    axes = np.linalg.qr(np.random.default_rng(7).standard_normal((BUCKETS, dimensions)))[0]
    for _ in range(ROUNDS):
        sent = axes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(sent)  # noqa: B023
            for part in _blocks(batches):
                matrix = _matrix(part["text"], rareness)
                total += matrix.T @ (matrix @ sent)  # noqa: B023
            yield pa.record_batch({"total": pa.array([total.tobytes()], pa.binary())})

        total = np.zeros_like(axes)
        for row in labelled.mapInArrow(run, "total binary").toLocalIterator():
            total += np.frombuffer(row["total"]).reshape(axes.shape)
        axes = np.linalg.qr(total)[0]
    return axes


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: Column,
    *,
    max_labelled: int = MAX_LABELLED,
    dimensions: int = DIMENSIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Voters:
    """Place labelled documents in a latent semantic space learnt from them.

    ``label`` is a 0/1 expression over ``labels``, which has an id. Rows without id or label are left out, as are
    labels of no document; several labels of one id count as several rows. At most about ``max_labelled`` labelled
    documents are used, chosen by a hash of the id; terms are weighted by their rareness in all documents. Without
    a labelled document every score is 0.5.
    """
    texts = docs.select(text_or_empty(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("_id"), label.cast("int").alias("label")).dropna()
    n = known.count()
    if n > max_labelled:
        drawn = F.shiftrightunsigned(F.xxhash64("_id", F.lit("voters")), 32)
        known = known.where(drawn < int(2**32 * max_labelled / n))
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    rows = rows.join(F.broadcast(known), "_id").select("text", "label")

    labelled = settle(rows, "labelled").coalesce(TASKS)
    counts = _documents_by_term(texts)
    rareness = np.log1p(max(texts.count(), 1) / np.maximum(counts, 1))
    axes = _axes(labelled, rareness, dimensions)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            vectors = _unit(_matrix(part["text"], rareness) @ axes)
            yield pa.record_batch({"vector": pa.array([v.tobytes() for v in vectors], pa.binary()), "label": part["label"]})

    placed = labelled.mapInArrow(place, "vector binary, label int").toArrow()
    placed = placed.sort_by([("vector", "ascending"), ("label", "ascending")])
    vectors = [np.frombuffer(vector.as_py(), dtype=np.float32) for vector in placed["vector"]]
    voting = placed["label"].to_numpy().astype(float)
    return Voters(
        rareness,
        axes.astype(np.float32),
        np.array(vectors, dtype=np.float32).reshape(-1, dimensions),
        voting,
        float(voting.mean()) if len(voting) else 0.5,
    )


def score(docs: DataFrame, voters: Voters, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score``, the share of label 1 among the nearest voters' votes.

    Every whole text is compared with all voters, a block of texts at a time. Equal texts have equal scores, up
    to rounding; a NULL text is an empty one. A text near no voter gets the share of label 1 among all. Rows given twice are scored
    twice; an empty table gives no rows; other columns are ignored.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = shared.value
        for part in _blocks(batches):
            scores = voters.votes(voters.place(part["text"]))
            yield pa.record_batch({"doc_id": part["doc_id"], "score": pa.array(scores)})

    return df.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double")
