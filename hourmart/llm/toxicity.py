"""Toxicity categories with a chain of linear classifiers."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import Scratch, hash_remainder, map_arrow, tuned, unpacked, with_texts

#: Hashed words and beginnings of words.
FEATURES = 1 << 18
PREFIX_CHARS = 5
#: Labelled rows that the classifiers learn from, at most; the bound of the sample.
TRAIN_ROWS = 8_000
#: A feature counts if this many rows of the sample have it.
LEAST_ROWS = 3
FOLDS = 3
#: Updates of the weights, rows of an update, step size and penalties.
UPDATES, UPDATE_ROWS, RATE, SQUARE_PENALTY, ABSOLUTE_PENALTY = 2_000, 128, 0.5, 1e-5, 1e-4
#: Thresholds to choose from by the out-of-fold predictions.
STEPS = 100
#: Words whose hashes a task remembers.
CACHE_WORDS = 300_000

_MARKS = re.compile(r"[^\w\s]+")


class Words:
    """Hashed features of texts: words and beginnings of words, with dampened counts."""

    def __init__(self) -> None:
        self.cache: dict[str, tuple[int, int]] = {}

    def hashes(self, word: str) -> tuple[int, int]:
        found = self.cache.get(word)
        if found is None:
            start = "^" + word[:PREFIX_CHARS]
            found = (zlib.crc32(word.encode()) % FEATURES, zlib.crc32(start.encode()) % FEATURES)
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = found
        return found

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts = Counter(_MARKS.sub("", (text or "").lower()).split())
        if not counts:
            return np.zeros(0, np.int64), np.zeros(0)
        both = np.array([self.hashes(w) for w in counts], np.int64).ravel()
        times = np.repeat(np.fromiter(counts.values(), float, len(counts)), 2)
        at, where = np.unique(both, return_inverse=True)
        return at, np.log1p(np.bincount(where, weights=times))


@dataclass
class Sample:
    """Labelled rows: features as one sparse matrix, labels and folds."""

    ends: np.ndarray
    at: np.ndarray
    value: np.ndarray
    folds: np.ndarray
    labels: np.ndarray

    def plain(self) -> tuple:
        return (self.ends, self.at, self.value, self.folds, self.labels)

    def scores(self, weights: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Probabilities; ``weights`` ends with those of earlier categories and a constant."""
        held = np.concatenate([[0.0], np.cumsum(weights[self.at] * self.value)])
        sums = held[self.ends] - held[self.ends - np.diff(self.ends, prepend=0)]
        tail = weights[len(weights) - 1 - extra.shape[1] :]
        return 1 / (1 + np.exp(-np.clip(sums + extra @ tail[:-1] + tail[-1], -40, 40)))

    def fit(self, rows: np.ndarray, place: int, extra: np.ndarray) -> np.ndarray:
        """Logistic regression by adaptive steps with both penalties, in a fixed random order."""
        size = int(self.at.max(initial=-1)) + 1
        total = size + extra.shape[1] + 1
        weights, seen = np.zeros(total), np.full(total, 1e-6)
        lengths = np.diff(self.ends, prepend=0)
        random = np.random.RandomState(17)
        order = np.zeros(0, np.int64)
        for _ in range(UPDATES if len(rows) else 0):
            if len(order) < UPDATE_ROWS:
                order = np.concatenate([order, rows[random.permutation(len(rows))]])
            part, order = order[:UPDATE_ROWS], order[UPDATE_ROWS:]
            n = lengths[part]
            place_of = np.repeat(np.arange(len(part)), n)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            cells = np.repeat(self.ends[part] - n, n) + inner
            at, value = self.at[cells], self.value[cells]
            sums = np.bincount(place_of, weights=weights[at] * value, minlength=len(part))
            sums += extra[part] @ weights[size:-1] + weights[-1]
            miss = 1 / (1 + np.exp(-np.clip(sums, -40, 40))) - self.labels[part, place]
            slope = np.zeros(total)
            slope[:size] = np.bincount(at, weights=value * miss[place_of], minlength=size)
            slope[size:-1] = extra[part].T @ miss
            slope[-1] = miss.sum()
            slope = slope / len(part) + SQUARE_PENALTY * weights
            seen += slope**2
            step = RATE / np.sqrt(seen)
            weights -= step * slope
            cut = step * ABSOLUTE_PENALTY
            cut[-1] = 0.0
            weights = np.sign(weights) * np.maximum(np.abs(weights) - cut, 0.0)
        return weights


@dataclass
class Chain:
    """Weights in chain order (of hashed words, earlier probabilities, a constant) and thresholds."""

    categories: list[str]
    weights: list[np.ndarray]
    thresholds: list[float]


def _threshold(probability: np.ndarray, labels: np.ndarray) -> float:
    """The bound with the best F1 of out-of-fold predictions; ties to the one nearest 0.5."""
    best, found = -1.0, 0.5
    for step in range(1, STEPS):
        said = probability >= step / STEPS
        wanted = said.sum() + labels.sum()
        f1 = 2 * (said * labels).sum() / wanted if wanted else 0.0
        if f1 > best + 1e-9 or (f1 > best - 1e-9 and abs(step / STEPS - 0.5) < abs(found - 0.5)):
            best, found = f1, step / STEPS
    return found


def _sampled(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str, text_col: str, train_rows: int, folds: int, scratch: Scratch) -> tuple[Sample, np.ndarray]:
    """The bounded sample of labelled rows, and the features that it keeps."""
    marks = [F.max(F.col(f"`{c}`").cast("double")).alias(f"y{i}") for i, c in enumerate(categories)]
    known = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(*marks).where("id is not null")
    for i in range(len(categories)):
        known = known.where(F.col(f"y{i}").isin(0.0, 1.0))
    # A bounded number of short rows: sent to the documents' tasks.
    chosen = scratch.store(known.orderBy(F.xxhash64("id"), "id").limit(train_rows), "chosen")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    own = [F.col(f"y{i}") for i in range(len(categories))]
    rows = (
        texts.where("text is not null")
        .join(F.broadcast(chosen), "id")
        .select("id", hash_remainder("id", folds).cast("int").alias("fold"), F.array(*own).alias("y"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            found = [words.of(t) for t in batch.column("text").to_pylist()]
            at = pa.array([a for a, _ in found], pa.list_(pa.int32()))
            value = pa.array([v for _, v in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "fold", "y")), at, value], ["id", "fold", "y", "at", "value"]
            )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, fold int, y array<double>, at array<int>, value array<float>"
    table = map_arrow(rows, run, schema).toArrow().sort_by("id").combine_chunks()
    scratch.drop("chosen")
    lengths = pa.compute.list_value_length(table["at"]).to_numpy().astype(np.int64)
    at, value = (table[c].combine_chunks().flatten().to_numpy() for c in ("at", "value"))
    kept, counts = np.unique(at, return_counts=True)
    kept = kept[counts >= LEAST_ROWS]
    held = np.isin(at, kept)
    ends = np.concatenate([[0], np.cumsum(held)])[np.cumsum(lengths)].astype(np.int64)
    labels_of = np.array(table["y"].to_pylist(), float).reshape(len(lengths), len(categories))
    places = np.searchsorted(kept, at[held]).astype(np.int32)
    sample = Sample(ends, places, value[held], table["fold"].to_numpy(), labels_of)
    return sample, kept


def learn(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    train_rows: int = TRAIN_ROWS,
    folds: int = FOLDS,
) -> Chain:
    """Fit the chain on labelled texts.

    ``labels`` has the identifier and a 0/1 column for each category.  At most
    ``train_rows`` labelled rows, those with the smallest hash of their identifier,
    are learned from; rows with a null label, text or identifier are not.  Of each
    category, models of the other folds predict the probabilities that later
    categories learn from, so none learns from a prediction of a row that its
    predecessor has seen; the model for new texts learns from all rows.  The models
    of a category are fitted in tasks side by side.
    """
    spark = tuned(docs.sparkSession)
    scratch = Scratch(spark, "toxicity")
    sample, kept = _sampled(docs, labels, categories, id_col, text_col, train_rows, folds, scratch)
    n = len(sample.folds)
    earlier = np.zeros((n, 0))
    weights, thresholds = [], []
    shared = spark.sparkContext.broadcast(sample.plain())
    for place in range(len(categories)):

        def run(batches: Iterator[pa.RecordBatch], place=place, extra=earlier) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            own = Sample(*shared.value)
            for batch in batches:
                for fold in batch.column("fold").to_pylist():
                    found = own.fit(np.flatnonzero(own.folds != fold), place, extra)
                    yield pa.RecordBatch.from_pydict({"fold": [fold], "weights": [found.tolist()]})

        parts = spark.createDataFrame([(k,) for k in range(-1, folds)], "fold int")
        fitted = map_arrow(parts.repartition(folds + 1), run, "fold long, weights array<double>")
        models = {r["fold"]: np.array(r["weights"]) for r in fitted.collect()}
        apart = np.zeros(n)
        for fold in range(folds):
            own = sample.folds == fold
            apart[own] = sample.scores(models[fold], earlier)[own]
        thresholds.append(_threshold(apart, sample.labels[:, place]))
        wide = np.zeros(FEATURES + place + 1)
        wide[kept[: len(models[-1]) - place - 1]] = models[-1][: len(models[-1]) - place - 1]
        wide[FEATURES:] = models[-1][len(models[-1]) - place - 1 :]
        weights.append(wide)
        earlier = np.column_stack([earlier, apart])
    shared.destroy()
    return Chain(categories, weights, thresholds)


def predict(
    docs: DataFrame, chain: Chain, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add for each category ``<category>_probability`` and ``is_<category>`` to all rows.

    The result has the columns ``keep`` of ``docs`` (default: all).  Categories are
    predicted in chain order from the words of the whole text and the probabilities
    of the earlier ones.  A null or blank text has no words.  A chain learned from no rows
    finds every probability 0.5 and no category.  Repeated rows get equal results; an empty table gives no
    rows; input columns named like result columns are replaced.
    """
    spark = tuned(docs.sparkSession)
    rows, texts_in, names = with_texts(docs, text_col, keep)
    shared = spark.sparkContext.broadcast(chain.weights)
    kinds = "".join(f", p{i} double" for i in range(len(chain.categories)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, models = Words(), shared.value
        for batch in batches:
            out = np.zeros((batch.num_rows, len(models)))
            for k, text in enumerate(texts_in(batch)):
                at, value = words.of(text)
                for place, own in enumerate(models):
                    total = own[at] @ value + own[FEATURES:-1] @ out[k, :place] + own[-1]
                    out[k, place] = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            columns = [pa.array(out[:, i]) for i in range(len(models))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *columns], ["row", *[f"p{i}" for i in range(len(models))]]
            )

    found = map_arrow(rows, run, f"row {rows.schema['row'].dataType.simpleString()}{kinds}")
    results = []
    for place, name in enumerate(chain.categories):
        probability = F.col(f"p{place}")
        learned = F.lit(bool(np.any(chain.weights[place])))
        results.append(probability.alias(f"{name}_probability"))
        results.append((learned & (probability >= chain.thresholds[place])).alias(f"is_{name}"))
    return unpacked(found, names, *results)
