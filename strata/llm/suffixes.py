"""Removal of byte strings that occur earlier, by radix passes over the suffixes of all texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import settle, text_or_empty

DEPTH = 100
# Bytes of the gram that is a suffix's first digit; a power of two.
GRAM = 32
# Bytes that are worked on at once.
CHUNK = 1 << 20

# Windows that the second digit takes together.
BLOCK = 12

# A run of ``n`` windows: ``place`` holds its offset, ``n``, the gram's distance and whether all its
# windows are known to occur earlier; ``head`` is the hash of what its windows have in common,
# ``whole`` that of all they cover.
RUNS = "doc long, place long, head long, whole long"
NO_ID = -(2**63)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each place on, by doubling the length."""
    hashes = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    power, length = np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while length < GRAM:
            hashes = hashes[:-length] * power + hashes[length:]
            power, length = power * power, 2 * length
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0x94D049BB133111EB)
        hashes ^= hashes >> np.uint64(29)
    return hashes


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` hashes in a row the place of the least, the first one of equals."""
    place, best, length = np.arange(len(hashes)), hashes, 1
    while length < width:
        step = min(length, width - length)
        later = best[step:] < best[:-step]
        place = np.where(later, place[step:], place[:-step])
        best = np.where(later, best[step:], best[:-step])
        length += step
    return place


def _pieces(texts: list[bytes], depth: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """``(document, offset, bytes)`` in lists of about ``CHUNK`` bytes; every window is in one piece."""
    chunk: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, max(len(text) - depth + 1, 0), CHUNK):
            piece = text[start : start + CHUNK + depth - 1]
            chunk.append((i, start, piece))
            size += len(piece)
            if size >= CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _runs_of(chunk: list[tuple[int, int, bytes]], depth: int) -> dict[str, np.ndarray]:
    """Runs of windows next to each other whose least gram is the same one."""
    sizes = np.array([len(piece) for _, _, piece in chunk])
    ends = sizes.cumsum()
    raw = b"".join(piece for _, _, piece in chunk)
    grams = _gram_hashes(np.frombuffer(raw, np.uint8))
    least = _least_places(grams, depth - GRAM + 1)
    piece_of = np.repeat(np.arange(len(chunk)), sizes)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + depth <= ends[piece_of])
    least, piece_of = least[starts], piece_of[starts]
    new = np.empty(len(starts), bool)
    new[:1] = True
    new[1:] = (np.diff(starts) != 1) | (np.diff(least) != 0) | (np.diff(piece_of) != 0)
    first = np.flatnonzero(new)
    n = np.diff(first, append=len(starts))
    at = starts[first]
    view, digest = memoryview(raw), xxhash.xxh3_64_intdigest
    stops = (at + n + depth - 1).tolist()
    whole = np.array([digest(view[a:b]) for a, b in zip(at.tolist(), stops, strict=True)], np.uint64)
    piece = piece_of[first]
    offsets = np.array([offset for _, offset, _ in chunk]) - (ends - sizes)
    return {
        "i": np.array([i for i, _, _ in chunk])[piece],
        "at": at + offsets[piece],
        "n": n,
        "lead": least[first] - at,
        "head": grams[least[first]].view(np.int64),
        "whole": whole.view(np.int64),
    }


def _digest(data: memoryview) -> int:
    return xxhash.xxh3_64_intdigest(data)


def _blocks_of(text: bytes, runs: list[tuple[int, int, int]], depth: int) -> Iterator[tuple[int, ...]]:
    """Second digit: ``BLOCK`` windows at set distances from the gram, by the bytes they share."""
    view = memoryview(text)
    for at, n, lead in runs:
        gram = at + lead
        for block in range((lead - n + 1) // BLOCK, lead // BLOCK + 1):
            low, high = max(lead - n + 1, block * BLOCK), min(lead, block * BLOCK + BLOCK - 1)
            start, count = gram - high, high - low + 1
            core = view[gram - block * BLOCK : gram - block * BLOCK - BLOCK + 1 + depth]
            whole = view[start : start + count - 1 + depth]
            yield start, count, 0, _digest(core), _digest(whole)


def _windows_of(text: bytes, runs: list[tuple[int, int, int]], depth: int) -> Iterator[tuple[int, ...]]:
    """Last digit: every window by all its bytes."""
    view, low = memoryview(text), (1 << 64) - 1
    for at, n, _ in runs:
        for start in range(at, at + n):
            digest = xxhash.xxh3_128_intdigest(view[start : start + depth])
            yield start, 1, 0, digest >> 64, digest & low


def _packed(at, n, lead, repeated):
    return at << 16 | n << 9 | lead << 1 | repeated


def _unpacked(place: int) -> tuple[int, int, int]:
    return place >> 16, place >> 9 & 127, place >> 1 & 255


def _batch(doc, at, n, lead, head, whole) -> pa.RecordBatch:
    """Rows of runs. Of runs that are equal, all but the first are marked here already, and spread."""
    place = _packed(at, n, lead, 0)
    order = np.lexsort((place, doc, whole, head))
    doc, place, head, whole = doc[order], place[order], head[order], whole[order]
    equal = (head[1:] == head[:-1]) & (whole[1:] == whole[:-1])
    group = np.concatenate([[0], np.cumsum(~equal)]) if len(doc) else np.zeros(0, int)
    first = np.concatenate([[0], np.flatnonzero(~equal) + 1])[group] if len(doc) else group
    later = (doc != doc[first]) | (place != place[first])
    mixed = (doc * 0x9E3779B97F4A7C1 ^ place) * 0x5851F42D4C957F2D
    head, whole = np.where(later, mixed, head), np.where(later, ~mixed ^ doc, whole)
    return pa.record_batch(
        [pa.array(column, pa.int64()) for column in (doc, place | later, head, whole)],
        ["doc", "place", "head", "whole"],
    )


def _first_digit(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch["doc"].to_numpy(zero_copy_only=False)
            texts = [value.as_py() for value in batch["text"]]
            found = [_runs_of(chunk, depth) for chunk in _pieces(texts, depth)]
            if found:
                r = {name: np.concatenate([part[name] for part in found]) for name in found[0]}
                yield _batch(docs[r["i"]], r["at"], r["n"], r["lead"], r["head"], r["whole"])

    return run


def _next_digit(cut, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows = batch["doc"].to_pylist(), []
            for doc, text, places in zip(docs, batch["text"], batch["places"], strict=True):
                runs = [_unpacked(place) for place in places.as_py()]
                rows += ((doc, *row) for row in cut(text.as_py(), runs, depth))
            if rows:
                columns = list(zip(*rows, strict=True))
                numbers = [np.array(column, np.int64) for column in columns[:4]]
                hashes = [np.array(column, np.uint64).view(np.int64) for column in columns[4:]]
                yield _batch(*numbers, *hashes)

    return run


def _passed(runs: DataFrame) -> DataFrame:
    """One radix pass: runs that occur earlier (``place`` is odd), and those to be looked at closer.

    Runs come together by ``head``. A run equal in ``whole`` to an earlier one is repeated in full. Of
    the rest a run stays open if others share its head; alone with it, it has no repeated window.
    """
    runs = runs.repartition("head")
    equal = Window.partitionBy("head", "whole").orderBy("doc", "place")
    alike = Window.partitionBy("head")
    runs = runs.withColumn("first", F.first(F.struct("doc", "place")).over(equal))
    runs = runs.withColumn("several", F.min("whole").over(alike) != F.max("whole").over(alike))
    known = F.col("place").bitwiseAND(F.lit(1)) == 1
    later = (F.col("doc") != F.col("first.doc")) | (F.col("place") != F.col("first.place"))
    return runs.where(known | later | F.col("several")).select(
        "doc", F.when(known | ~later, F.col("place")).otherwise(F.col("place") + 1).alias("place")
    )


def _of_documents(places: DataFrame, repeated: bool) -> DataFrame:
    wanted = F.col("place").bitwiseAND(F.lit(1)) == int(repeated)
    return places.where(wanted).groupBy("doc").agg(F.collect_list("place").alias("places"))


def _spans(places: list[int], depth: int) -> list[tuple[int, int]]:
    """Maximal stretches that the windows of the runs cover."""
    spans: list[tuple[int, int]] = []
    for at, n, _ in sorted(map(_unpacked, places)):
        end = at + n - 1 + depth
        if spans and at <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((at, end))
    return spans


CUT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cutter(depth: int, with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch["text"], batch["places"], strict=True):
                data = text.as_py()
                spans = [(a, min(b, len(data))) for a, b in _spans(places.as_py() or [], depth) if a < len(data)]
                edges = [0, *(edge for span in spans for edge in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((len(data), len(data) - len(kept), len(spans), digest, kept))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            many = 5 if with_kept else 4
            yield pa.record_batch([batch["doc"], *arrays[:many]], ["doc", *names[:many]])

    return run


def remove_repeats(
    docs: DataFrame,
    *,
    depth: int = DEPTH,
    with_kept: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut every byte covered by a ``depth``-byte string that also starts earlier.

    Earlier means in a document with a smaller id, or in the same one further left. The suffixes of
    all texts are sorted by most-significant-digit passes as far as ``depth`` bytes and no further;
    those equal to that depth are the repeated strings. The digits are chosen so that few rows move:

    1. the least ``GRAM``-byte gram of the window, which equal windows share at the same distance. One
       row stands for the run of neighbouring windows that have it. Runs equal in all bytes they cover
       are settled; a run alone with its gram has no repeat.
    2. of the open runs, blocks of ``BLOCK`` windows, by the bytes all windows of a block contain,
    3. of the open blocks, every window by all its bytes.

    Bytes are compared by 128 bits of hash. Equal runs of one batch are merged before the shuffle, so
    a passage that a third of all documents share comes down to a row per batch.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, ``with_kept``, the bytes left. A
    NULL text is an empty one; a NULL id counts as the smallest. A row given twice is one document
    given twice: both are cut alike. Texts that share an id without being equal are cut at the same
    offsets.
    """
    if not GRAM < depth <= GRAM + 126:
        raise ValueError(f"depth must be over {GRAM} and at most {GRAM + 126}")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc")
    texts = docs.select(doc, text_or_empty(text_col).cast("binary").alias("text"))
    placed = settle(_passed(texts.mapInArrow(_first_digit(depth), RUNS)), "repeated-runs")
    dealt = texts.repartition("doc")
    marks = [placed]
    for cut in (_blocks_of, _windows_of):
        opened = dealt.join(_of_documents(marks[-1], False), "doc")
        marks.append(_passed(opened.mapInArrow(_next_digit(cut, depth), RUNS)))
    repeated = marks[0].unionByName(marks[1]).unionByName(marks[2])
    joined = dealt.join(_of_documents(repeated, True), "doc", "left")
    result = joined.mapInArrow(_cutter(depth, with_kept), CUT + (", kept binary" if with_kept else ""))
    columns = [name for name in result.columns if name != "doc"]
    return result.select(F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), *columns)
