"""Toxicity by a classifier chain over hashed word features.

Categories are predicted one after another; each linear model also sees the earlier
categories' probabilities. Those come from models trained on other folds, so a later model
learns from probabilities as uncertain as those it will see. Features are the presence of
words and word beginnings, hashed, and scaled by their log-odds in the training fold.

The models are fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest
hashes of their ids); every document is scored.

Defined results: a text without words has no features and chance 0; NULL ids and
labels take no part in training; of repeated labels the largest counts; without both
classes of a category its probability is the share seen (0 without labels); rows with
equal ids are each scored; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.slices import slices

SAMPLE_ROWS = 12_000
FEATURES = 1 << 18
FOLDS = 4
ROUNDS = 60
PENALTY = 2e-4
BEGINNINGS = (4, 5, 6)


def feature_numbers(text: Column, size: int = FEATURES) -> Column:
    """Distinct hashed features: words, and the first characters of longer words."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")
    words = F.array_remove(F.array_distinct(words), "")
    parts = [words]
    for n in BEGINNINGS:
        longer = F.filter(words, lambda w, n=n: F.char_length(w) > n)
        parts.append(F.transform(longer, lambda w, n=n: F.concat(F.lit(f"^{n}"), F.substring(w, 1, n))))
    hashed = F.transform(F.concat(*parts), lambda w: F.pmod(F.xxhash64(w), F.lit(size)).cast("int"))
    return F.array_distinct(F.filter(hashed, lambda x: x.isNotNull()))


# --- linear models on presence features -------------------------------------------


class Rows:
    """Sparse presence rows: feature numbers and where each row starts."""

    def __init__(self, numbers: np.ndarray, ends: np.ndarray) -> None:
        self.numbers, self.ends = numbers, ends
        self.counts = np.diff(ends, prepend=0)

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the weights of each row's features."""
        upto = np.concatenate([[0.0], np.cumsum(weights[self.numbers], dtype=np.float64)])
        return upto[self.ends] - upto[self.ends - self.counts]

    def spread(self, values: np.ndarray, size: int) -> np.ndarray:
        """For each feature, the sum of the values of the rows that have it."""
        return np.bincount(self.numbers, np.repeat(values, self.counts), size)

    def take(self, rows: np.ndarray) -> Rows:
        starts = self.ends - self.counts
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        place = np.repeat(starts[rows] - ends + counts, counts) + np.arange(counts.sum())
        return Rows(self.numbers[place], ends)


class Linear:
    """Logistic regression on presence features scaled by log-odds, and on dense columns."""

    def fit(self, rows: Rows, dense: np.ndarray, y: np.ndarray, size: int) -> Linear:
        share = float(y.mean()) if len(y) else 0.0
        self.weights, self.dense = np.zeros(size, np.float32), np.zeros(dense.shape[1])
        self.offset = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
        if share in (0.0, 1.0):
            return self
        with_one, all_rows = rows.spread(y, size), rows.spread(np.ones(len(y)), size)
        positive, negative = y.sum(), len(y) - y.sum()
        odds = np.log((with_one + 1) / (positive + 2)) - np.log((all_rows - with_one + 1) / (negative + 2))
        scale = np.where(all_rows >= 2, odds, 0.0)
        balance = np.where(y == 1, 0.5 / positive, 0.5 / negative) ** 0.5
        balance /= balance.sum()
        # Adam on the full gradient; the penalty acts on the scaled weights.
        state = [np.zeros(size), np.zeros(dense.shape[1]), np.zeros(1)]
        first, second = [s.copy() for s in state], [s.copy() for s in state]
        state[2][0] = self.offset
        for t in range(1, ROUNDS + 1):
            margin = rows.sums(state[0] * scale) + dense @ state[1] + state[2][0]
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * balance
            slopes = [
                rows.spread(error, size) * scale + PENALTY * state[0],
                dense.T @ error + PENALTY * state[1],
                np.array([error.sum()]),
            ]
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope**2
                step = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
                state[k] -= 0.1 * step
        self.weights, self.dense, self.offset = (state[0] * scale).astype(np.float32), state[1], float(state[2][0])
        return self

    def chances(self, rows: Rows, dense: np.ndarray) -> np.ndarray:
        margin = rows.sums(self.weights) + dense @ self.dense + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_chain(rows: Rows, labels: np.ndarray, folds: np.ndarray, size: int = FEATURES) -> list[Linear]:
    """One model per label column; later ones see out-of-fold chances of earlier ones."""
    models, dense = [], np.zeros((len(folds), 0))
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        apart = np.zeros(len(y))
        for fold in range(FOLDS):
            own, other = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            model = Linear().fit(rows.take(other), dense[other], y[other], size)
            apart[own] = model.chances(rows.take(own), dense[own])
        models.append(Linear().fit(rows, dense, y, size))
        dense = np.column_stack([dense, apart])
    return models


def chain_chances(models: Sequence[Linear], rows: Rows) -> np.ndarray:
    dense = np.zeros((len(rows.ends), 0))
    for model in models:
        dense = np.column_stack([dense, model.chances(rows, dense)])
    return dense


# --- on DataFrames -----------------------------------------------------------------


def _rows_of(column: pa.Array) -> Rows:
    ends = column.offsets.to_numpy()[1:].astype(np.int64) - column.offsets[0].as_py()
    return Rows(column.flatten().to_numpy(), ends)


def train(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_col: str, text_col: str,
    limit: int = SAMPLE_ROWS,
) -> list[Linear]:
    """Fit the chain; ``categories`` are boolean columns of ``labels``, in chain order."""
    names = list(categories)
    known = labels.select(F.col(id_col).alias("__id"), *[c.cast("int").alias(f"__{n}") for n, c in categories.items()])
    known = known.dropna().groupBy("__id").agg(*[F.max(f"__{n}").alias(f"__{n}") for n in names])
    # The sample is drawn among the label rows, so texts are joined for at most ``limit`` ids.
    drawn = known.orderBy(F.xxhash64("__id"), "__id").limit(limit)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    sample = texts.join(F.broadcast(drawn), "__id").select(
        F.pmod(F.xxhash64("__id", F.lit(5)), F.lit(FOLDS)).cast("int").alias("fold"),
        *[f"__{n}" for n in names],
        feature_numbers(F.col("__text")).alias("features"),
    )
    table = sample.toArrow().combine_chunks()
    if not table.num_rows:
        return [Linear().fit(Rows(np.zeros(0, int), np.zeros(0, int)), np.zeros((0, k)), np.zeros(0), FEATURES) for k in range(len(names))]
    found = table.column("features").combine_chunks()
    y = np.column_stack([table.column(f"__{n}").to_numpy() for n in names])
    return fit_chain(_rows_of(found), y, table.column("fold").to_numpy())


def score(docs: DataFrame, models: list[Linear], names: Sequence[str], text_col: str) -> DataFrame:
    """Add the chance of each category, as ``p_<name>``, to every row of ``docs``.

    An extra column of such a name is replaced.
    """
    # With the class's own code, as executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(models))
    added = [f"p_{n}" for n in names]
    docs = docs.drop(*added)
    kept = docs.columns
    # The last column is ours, whatever the others are called.
    features = "features" + "_" * max(map(len, kept), default=0)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = cloudpickle.loads(shared.value)
        for batch in slices(batches):
            rows = _rows_of(batch.column(features))
            chances = chain_chances(chain, rows) * (rows.counts > 0)[:, None]
            own = [batch.column(c) for c in kept] + [pa.array(chances[:, k]) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(own, [*kept, *added])

    schema = T.StructType(list(docs.schema))
    for name in added:
        schema = schema.add(name, T.DoubleType())
    return docs.withColumn(features, feature_numbers(F.col(text_col))).mapInArrow(predict, schema)


def categories() -> dict[str, Column]:
    """The categories of the ``labels`` table, in chain order."""
    return {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
