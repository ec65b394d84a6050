"""Toxicity by a classifier chain of linear models."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import settle, text_or_empty

FOLDS = 3
# Tasks that sum up the rows a chain is fitted on, whose number is bounded; rows looked at together.
TASKS = 8
BLOCK = 500
STEM = 4
# Labelled rows that the chain is fitted on, at most; beyond it a hash of the id chooses.
MAX_TRAINING_ROWS = 20_000
# Words a model looks at, at most; they must be in some documents and tell the classes apart.
MAX_WORDS = 300
LEAST_DOCUMENTS = 5
LEAST_DEVIATION = 5.0

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Linear:
    """A logistic model: weights of words, of the probabilities before it, and the constant."""

    words: dict[str, float]
    before: tuple[float, ...]
    constant: float

    def __call__(self, tokens: set[str], before: Sequence[float]) -> float:
        margin = self.constant + sum(w * p for w, p in zip(self.before, before, strict=True))
        margin += sum(self.words[t] for t in tokens if t in self.words)
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


@dataclass(frozen=True)
class Chain:
    """Categories in order, each with its model; a model also sees the probabilities before it."""

    categories: tuple[str, ...]
    models: tuple[Linear, ...]


def tokens_of(text: str) -> set[str]:
    """The distinct lower-cased words of a text, and the beginnings of words, marked as such."""
    words = set(WORD.findall(text.lower()))
    return words | {f"^{word[:STEM]}" for word in words}


def probability(category: str) -> str:
    return f"p_{category}"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _with_tokens(df: DataFrame) -> DataFrame:
    """Replace the column ``_text``, the last one, by ``_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            found = [sorted(tokens_of(value.as_py())) for value in batch["_text"]]
            columns = {name: batch[name] for name in batch.schema.names if name != "_text"}
            yield pa.record_batch(columns | {"_tokens": pa.array(found, pa.list_(pa.string()))})

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "_text")
    return df.mapInArrow(run, f"{kept}, _tokens array<string>")


@dataclass
class Fit:
    """A model while it is fitted: places of its words, its weights, and the fold that is left out."""

    columns: np.ndarray
    weights: np.ndarray
    left_out: int | None
    settled: bool = False


def _probabilities(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _designs(
    batch: pa.RecordBatch, n_words: int, earlier: list[dict[int, Fit]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence of words, out-of-fold probabilities of the earlier categories, and folds of some rows."""
    presence = np.zeros((batch.num_rows, n_words))
    sizes = np.diff(batch["_words"].offsets.to_numpy())
    presence[np.repeat(np.arange(batch.num_rows), sizes), batch["_words"].flatten().to_numpy()] = 1
    folds = batch["_fold"].to_numpy()
    before = np.zeros((batch.num_rows, 0))
    for models in earlier:
        found = np.zeros(batch.num_rows)
        for fold, model in models.items():
            mine = folds == fold
            found[mine] = _probabilities(_design(presence[mine], before[mine], model) @ model.weights)
        before = np.column_stack([before, found])
    return presence, before, folds


def _design(presence: np.ndarray, before: np.ndarray, model: Fit) -> np.ndarray:
    return np.column_stack([presence[:, model.columns], before, np.ones(len(presence))])


def _newton(
    sample: DataFrame, category: str, models: list[Fit], earlier: list[dict[int, Fit]], n_words: int, ridge: float, rounds: int = 25
) -> None:
    """Ridge logistic regression by Newton's method, of several models at once; the last weight is the constant.

    Tasks sum up gradients and second derivatives over their rows, and only these sums reach the driver: a square
    of the number of words, for each task and model that is not settled yet.
    """
    for _ in range(rounds):
        open_ = [i for i, model in enumerate(models) if not model.settled]
        if not open_:
            return

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {i: np.zeros((len(models[i].weights) + 1, len(models[i].weights))) for i in open_}  # noqa: B023
            for batch in _blocks(batches):
                presence, before, folds = _designs(batch, n_words, earlier)
                label = batch[category].to_numpy()
                for i in open_:  # noqa: B023
                    used = slice(None) if models[i].left_out is None else folds != models[i].left_out
                    design = _design(presence[used], before[used], models[i])
                    p = _probabilities(design @ models[i].weights)
                    sums[i][0] += design.T @ (p - label[used])
                    sums[i][1:] += (design * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ design
            yield pa.record_batch(
                {"model": pa.array(list(sums)), "sums": pa.array([s.tobytes() for s in sums.values()], pa.binary())}
            )

        totals = {i: np.zeros((len(models[i].weights) + 1, len(models[i].weights))) for i in open_}
        for row in sample.mapInArrow(run, "model bigint, sums binary").toLocalIterator():
            totals[row["model"]] += np.frombuffer(row["sums"]).reshape(totals[row["model"]].shape)
        for i, total in totals.items():
            penalty = np.full(len(models[i].weights), ridge)
            penalty[-1] = 1e-6
            step = np.linalg.solve(total[1:] + np.diag(penalty), total[0] + penalty * models[i].weights)
            models[i].weights = models[i].weights - step
            models[i].settled = bool(np.abs(step).max() < 1e-6)


def _with_words(rows: DataFrame, place: dict[str, int], categories: Sequence[str]) -> DataFrame:
    """Fold, categories and the places of the chosen words of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            words = [[place[t] for t in tokens.as_py() if t in place] for tokens in batch["_tokens"]]
            columns = {name: batch[name] for name in ("_fold", *categories)}
            yield pa.record_batch(columns | {"_words": pa.array(words, pa.list_(pa.int32()))})

    kept = ", ".join(f"`{c}` int" for c in ("_fold", *categories))
    return rows.select("_fold", *categories, "_tokens").mapInArrow(run, f"{kept}, _words array<int>")


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    *,
    max_rows: int = MAX_TRAINING_ROWS,
    max_words: int = MAX_WORDS,
    ridge: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain | None:
    """Fit one model per category, in order.

    ``labels`` has an id and a 0/1 column per category; rows with a NULL in one of these are left out.
    Words are counted by class in Spark; a model takes those whose share of documents differs most
    between the classes, in standard deviations. No row reaches the driver, only words, ``max_words`` a model at
    most, and sums over the rows. The chosen labels, ``max_rows`` at most, are broadcast.

    What a later model sees of an earlier category while it is fitted are out-of-fold probabilities:
    every row is scored by a model whose words and weights come from the other folds. The models kept
    are fitted on all rows.

    Without a labelled document there is no chain (``None``). A category with one class only gets a
    model without words. Several labels of one id count as several rows.
    """
    known = labels.select(F.col(id_col).alias("_id"), *[F.col(c).cast("int") for c in categories]).dropna()
    n_labels = known.count()
    if n_labels > max_rows:
        drawn = F.shiftrightunsigned(F.xxhash64("_id", F.lit("sample")), 32)
        known = known.where(drawn < int(2**32 * max_rows / n_labels))
    known = known.withColumn("_fold", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    rows = settle(_with_tokens(texts.join(F.broadcast(known), "_id").drop("_id")), "labelled")

    def sums() -> list[Column]:
        """Per fold: rows, and rows of each category."""
        parts = []
        for fold in range(FOLDS):
            here = (F.col("_fold") == fold).cast("long")
            parts.append(F.sum(here).alias(f"n_{fold}"))
            parts += [F.sum(here * F.col(c)).alias(f"{c}_{fold}") for c in categories]
        return parts

    total = rows.agg(*sums()).first().asDict()
    if not sum(total[f"n_{fold}"] or 0 for fold in range(FOLDS)):
        return None
    counted = rows.select("_fold", *categories, F.explode("_tokens").alias("token")).groupBy("token").agg(*sums())
    seen = sum((F.col(f"n_{fold}") for fold in range(FOLDS)), F.lit(0))
    counted = settle(counted.where(seen >= LEAST_DOCUMENTS), "words")

    def telling(category: str, left_out: int | None) -> list[str]:
        """The words that tell a category best in all folds but one."""
        folds = [fold for fold in range(FOLDS) if fold != left_out]
        n = sum(total[f"n_{f}"] for f in folds)
        positive = sum(total[f"{category}_{f}"] for f in folds)
        if not 0 < positive < n:
            return []
        with_word = sum((F.col(f"n_{f}") for f in folds), F.lit(0))
        both = sum((F.col(f"{category}_{f}") for f in folds), F.lit(0))
        share = with_word / n
        gap = both / positive - (with_word - both) / (n - positive)
        spread = F.sqrt(share * (1 - share) * (1 / positive + 1 / (n - positive)))
        deviation = gap / F.nullif(spread, F.lit(0.0))
        chosen = counted.select("token", F.abs(deviation).alias("deviation")).where(F.col("deviation") >= LEAST_DEVIATION)
        return [row["token"] for row in chosen.orderBy(F.desc("deviation"), "token").limit(max_words).collect()]

    left_outs = {c: [None, *range(FOLDS)] if c != categories[-1] else [None] for c in categories}
    chosen = {(c, out): telling(c, out) for c in categories for out in left_outs[c]}
    vocabulary = sorted({word for words in chosen.values() for word in words})
    place = {word: i for i, word in enumerate(vocabulary)}
    sample = settle(_with_words(rows, place, categories), "sample").coalesce(TASKS)

    models: list[Linear] = []
    earlier: list[dict[int, Fit]] = []
    for category in categories:
        fits = [
            Fit(np.array([place[w] for w in chosen[category, out]], dtype=int), np.zeros(len(chosen[category, out]) + len(earlier) + 1), out)
            for out in left_outs[category]
        ]
        _newton(sample, category, fits, earlier, len(vocabulary), ridge)
        words, weights = chosen[category, None], fits[0].weights
        models.append(
            Linear(
                dict(zip(words, weights[: len(words)].tolist(), strict=True)),
                tuple(weights[len(words) : -1].tolist()),
                float(weights[-1]),
            )
        )
        earlier.append({fit.left_out: fit for fit in fits if fit.left_out is not None})
    return Chain(tuple(categories), tuple(models))


def score(docs: DataFrame, chain: Chain | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the probability of every category of the chain, ``p_<category>``.

    A NULL text is an empty one. Rows that occur twice are scored twice; without a chain there are no
    probabilities, only ids.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    if chain is None:
        return df.select("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [probability(category) for category in chain.categories]
        for batch in batches:
            rows = []
            for value in batch["text"]:
                tokens, found = tokens_of(value.as_py()), []
                for model in chain.models:
                    found.append(model(tokens, found))
                rows.append(found)
            scores = np.array(rows, dtype=float).reshape(-1, len(names))
            columns = {name: pa.array(scores[:, i]) for i, name in enumerate(names)}
            yield pa.record_batch({"doc_id": batch["doc_id"]} | columns)

    kind = df.schema["doc_id"].dataType.simpleString()
    added = ", ".join(f"{probability(category)} double" for category in chain.categories)
    return df.mapInArrow(run, f"doc_id {kind}, {added}")


def flag(scores: DataFrame, categories: Sequence[str], *, threshold: float = 0.3) -> DataFrame:
    """Add a 0/1 column per category: 1 where its probability is at least ``threshold``."""
    for category in categories:
        known = probability(category) in scores.columns
        p = F.col(probability(category)) if known else F.lit(0.0)
        scores = scores.withColumn(category, (p >= threshold).cast("int"))
    return scores
