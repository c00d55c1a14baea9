"""Quality of documents by kernel ridge regression on their statistics.

Random Fourier features approximate a Gaussian kernel over standardised
statistics. Each partition sums its share of the normal equations, the sums are
added up and solved once, and isotonic regression on rows kept apart turns the
outcome into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField

from tidemark.llm.common import fold, free_name, saved, with_text_columns
from tidemark.llm.features import NAMES, statistics

FOLDS, HELD_OUT_FOLD = 4, 2
KEEP_SCORE = 0.7
# At most so many labelled documents are used to fit.
FIT_ROWS = 20_000
FEATURES = 300
RIDGE = 1e-3
WIDTH = 4.0


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray
    solution: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.weights + self.phase)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.solution

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: the mean x and y of each block, rising."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            a1, b1, n1 = blocks.pop()
            a0, b0, n0 = blocks[-1]
            blocks[-1] = [(a0 * n0 + a1 * n1) / (n0 + n1), (b0 * n0 + b1 * n1) / (n0 + n1), n0 + n1]
    table = np.array(blocks)
    return table[:, 0], table[:, 1]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, limit: int = FIT_ROWS):
    """Text, label and a hash of at most `limit` labelled documents outside the
    held-out fold. The ids are bounded, so they go to every executor and no text is
    shuffled. Labels that contradict each other or are null are left aside."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_y"))
        .where("y = _y")
        .select("doc_id", F.col("y").cast("double").alias("y"), F.xxhash64("doc_id").alias("hash"))
    )
    chosen = known.orderBy("hash", "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def _summed(rows: DataFrame, parts, size: int) -> np.ndarray:
    """The sum over partitions of the vectors that `parts` gives, in two steps
    so that no task adds up more than a share of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for vector in parts(batches):
            total = vector if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total = total + np.frombuffer(value.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    shares = rows.mapInArrow(run, "sum binary")
    for n in (16, 1):
        shares = shares.repartition(n).mapInArrow(add, "sum binary")
    return np.frombuffer(shares.first()["sum"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", seed: int = 11, limit: int = FIT_ROWS) -> Model | None:
    """The model, or None without two classes to learn from."""
    d = len(NAMES)
    stats_fields = [StructField(f"s{i}", DoubleType()) for i in range(d)]
    with_stats = with_text_columns(
        training_rows(docs, labels, label, FOLDS, HELD_OUT_FOLD, limit),
        "text", stats_fields, lambda: lambda texts: list(statistics(texts).T),
    ).drop("text")
    rows = saved(with_stats)  # at most `limit` rows of numbers
    sums = rows.agg(
        F.count("*"), F.min("y"), F.max("y"),
        *[F.avg(f.name) for f in stats_fields], *[F.stddev_pop(f.name) for f in stats_fields],
    ).first()
    if not sums[0] or sums[1] == sums[2]:
        return None
    rng = np.random.default_rng(seed)
    mean, scale = np.array(sums[3 : 3 + d]), np.maximum(np.array(sums[3 + d :]), 1e-6)
    model = Model(
        mean, scale, rng.normal(size=(d, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]),
    )
    size = FEATURES + 1
    calibrate = F.pmod("hash", F.lit(4)) == 0

    def numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        return np.stack(columns[1:], axis=1), columns[0]

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if len(batch):
                x, y = numbers(batch)
                z = model.fourier(x)
                yield np.concatenate([(z.T @ z).ravel(), z.T @ y, [len(y)]])

    names = ["y", *[f.name for f in stats_fields]]
    training = rows.where(~calibrate).select(names)
    if training.isEmpty():
        training = rows.select(names)
    total = _summed(training, equations, size * size + size + 1)
    gram = total[: size * size].reshape(size, size)
    model.solution = np.linalg.solve(gram + RIDGE * total[-1] * np.eye(size), total[size * size : -1])
    held = rows.where(calibrate).select(names).toArrow()  # at most a quarter of `limit` rows
    if not held.num_rows:
        held = rows.select(names).toArrow()
    x, y = numbers(held.combine_chunks().to_batches()[0])
    model.knots, model.values = isotonic(model.raw(x), y)
    return model


def score(docs: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    """`docs` with the probability that a text is good. Null texts count as
    empty, and an empty text is scored like any other; without a model every
    score is 0.5. Rows and other columns stay; a column named `out` is replaced."""
    docs = docs.drop(out)

    def make():
        if model is None:
            return lambda texts: [np.full(len(texts), 0.5)]
        return lambda texts: [model.score(statistics(texts))]

    return with_text_columns(docs, "text", [StructField(out, DoubleType())], make)


def keep_good(docs: DataFrame, model: Model | None, least: float = KEEP_SCORE) -> DataFrame:
    """The rows of `docs` whose text scores at least `least`. Without a model
    nothing is rejected."""
    if model is None:
        return docs
    name = free_name(docs, "_quality")
    return score(docs, model, name).where(F.col(name) >= least).drop(name)
