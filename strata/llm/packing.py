"""Best-fit packing of token pieces into sequences by minimum bin slack."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bits_for, numbered, settle, text_or_empty

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"

# How byte-level BPE of this kind cuts text before merging, and its marker token.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKER = "<|endoftext|>"

# Characters that one of the libraries takes for white space and the other does not.
ODD = re.compile("[\x1c-\x1f]")


class Encoder:
    """Token ids as little-endian 32-bit bytes.

    The ids are those of the tokenizer file. The merging is done by the rank file of the same
    vocabulary where there is one, which is several times as fast; texts with the marker token or
    with white space that the two treat differently go to the tokenizer itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str | None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.ranks = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding(
                "ranks", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> bytes:
        if self.ranks is None or MARKER in text or ODD.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


def public_files() -> dict[str, str]:
    """Places of the public vocabulary's two files, the same on every machine."""
    import public_tokenizers

    return {
        "tokenizer_path": str(public_tokenizers.path("byte_bpe_50k.json")),
        "ranks_path": str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    }


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str, ranks_path: str | None) -> Encoder:
    return Encoder(tokenizer_path, ranks_path)


def cut_pieces(
    docs: DataFrame,
    *,
    tokenizer_path: str,
    ranks_path: str | None = None,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token ids of each document, ``end_id`` behind them, cut where longer than ``capacity``.

    The first piece of a long document takes what full pieces leave over. Returns ``doc_id, piece,
    start, length, ids_crc32``.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, ranks_path).encode
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                first = total if total <= capacity else total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    rows.append((doc, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            yield pa.record_batch(
                [
                    pa.array(list(column), kind)
                    for column, kind in zip(
                        zip(*rows, strict=True) if rows else [()] * 5,
                        (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()),
                        strict=True,
                    )
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, PIECES)


def fullest(counts: dict[int, int], space: int) -> list[int]:
    """Lengths, largest first, that together fill ``space`` as far as any choice can.

    Bit ``n`` of a set tells that some of the lengths seen so far sum to ``n``. Walking back from
    the highest bit, a length is taken only where the sum could not be made without it.
    """
    mask, reach, layers = (1 << (space + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        for _ in range(min(counts[length], space // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            layers.append((length, reach))
            reach = grown
        if reach >> space:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(layers):
        if not before >> left & 1:
            chosen.append(length)
            left -= length
    return sorted(chosen, reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Minimum bin slack over a histogram of lengths: ``[(lengths of a bin, number of such bins)]``.

    Each bin starts with the largest length left; the fullest combination for the rest of it is
    removed as often as the counts allow, which uses up at least one length, so the number of steps
    follows the capacity and not the number of pieces.
    """
    counts, plan = {n: c for n, c in histogram.items() if c}, []
    while counts:
        largest = max(counts)
        counts[largest] -= 1
        chosen = [largest, *fullest({n: c for n, c in counts.items() if c}, capacity - largest)]
        counts[largest] += 1
        times = min(counts[n] // chosen.count(n) for n in set(chosen))
        for n in set(chosen):
            counts[n] -= times * chosen.count(n)
            if not counts[n]:
                del counts[n]
        plan.append((chosen, times))
    return plan


def _runs(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows ``length, first rank, pieces per bin, first bin, offset`` in order of length and rank."""
    used: dict[int, int] = {}
    rows, first_bin = [], 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            per_bin = chosen.count(length)
            rows.append((length, used.get(length, 0), per_bin, first_bin, offset))
            used[length] = used.get(length, 0) + per_bin * times
            offset += per_bin * length
        first_bin += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, *, capacity: int = 2048) -> DataFrame:
    """Give every piece its sequence and its offset there, in as few sequences as it can.

    The histogram of lengths (``capacity`` rows at most, whatever the input) is all that reaches the
    driver; the combinations chosen on it go back to the tasks. A piece finds its bin from its rank
    among the pieces of its length, and ranks are counted in cells, so a length that all pieces share
    is ranked by many tasks. Offsets within a sequence are gapless from 0.

    ``pieces`` must be stored: it is read more than once. Rows with NULL ids and repeated rows are
    packed like any other; an empty table gives no rows.
    """
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = _runs(plan_bins(histogram, capacity))
    scale = max(histogram.values(), default=0) + 1
    starts = runs[:, 0] * scale + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False)
            rank = batch["place"].to_numpy(zero_copy_only=False)
            run = runs[np.searchsorted(starts, length * scale + rank, side="right") - 1]
            into = rank - run[:, 1]
            columns = {name: batch[name] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            columns["sequence_id"] = pa.array(run[:, 3] + into // run[:, 2], pa.int64())
            columns["offset"] = pa.array(run[:, 4] + into % run[:, 2] * length, pa.int64())
            yield pa.record_batch(columns)

    bits = bits_for(sum(histogram.values()))
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", "piece", "ids_crc32"), 1)
    cells = pieces.withColumn("drawn", drawn).withColumn("cell", F.shiftright("drawn", 63 - bits))
    ranked = numbered(cells, ["length"], "cell", ["drawn", "doc_id", "piece", "ids_crc32"], "place")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "place"]
    return ranked.select(*columns).mapInArrow(place, PLACED)


def pack_documents(docs: DataFrame, *, capacity: int = 2048, **options) -> DataFrame:
    """``cut_pieces``, stored, then ``pack``."""
    return pack(settle(cut_pieces(docs, capacity=capacity, **options), "pieces"), capacity=capacity)
