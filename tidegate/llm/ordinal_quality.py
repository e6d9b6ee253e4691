"""Quality grade by a cumulative-link (ordered logistic) model over hashed text features.

All grades share one weight vector over hashed byte n-grams; P(grade > k) = logistic(w.x - t_k) with ordered thresholds
t_0 < t_1 < ... . Results are the expected grade, the tail probability P(grade >= least) and ``kept``: the tail
probability reaches a limit. Thresholds are kept ordered by fitting the first and the logarithms of the gaps.

Null and empty texts have zero vectors: they get their own row with expected grade 0, tail probability 0 and are not
kept. With no rated rows nothing is known: expected grade and tail probability are 0. Repeated rows each get a row, an
empty table gives none, and other columns are left out.

The fit uses at most ``Settings.training_rows`` rated rows, evenly over the grades, chosen by a hash of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import hashed
from tidegate.llm.language_id import sample, vectors_of
from tidegate.llm.shared import as_bytes, chunks


@dataclass(frozen=True)
class Settings:
    training_rows: int = 4500
    bits: int = 12
    orders: tuple[int, ...] = (1, 2, 3)
    penalty: float = 2e-5
    rounds: int = 400
    rate: float = 0.1
    least: int = 1
    limit: float = 0.4


@dataclass
class Model:
    settings: Settings
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[bytes | None]) -> np.ndarray:
        """P(grade > k) for each threshold: texts x thresholds; zero for texts without a byte."""
        level = hashed.scores(texts, self.weights[None, :], self.settings.orders)
        tails = 1.0 / (1.0 + np.exp(self.thresholds[None, :] - level))
        return np.where(np.array([bool(t) for t in texts])[:, None], tails, 0.0)


def fit(x: np.ndarray, rank: np.ndarray, n_grades: int, penalty: float, rounds: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by full-batch gradient steps with moment estimates; grades weigh alike. rank: 0..n-1."""
    k = n_grades - 1
    each = 1.0 / np.maximum(np.bincount(rank, minlength=n_grades), 1)[rank] / n_grades
    values = np.concatenate([np.zeros(x.shape[1]), [-1.0], np.zeros(max(k - 1, 0))])
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        w, t0, gaps = values[: x.shape[1]], values[x.shape[1]], np.exp(values[x.shape[1] + 1 :])
        t = t0 + np.concatenate([[0.0], np.cumsum(gaps)])
        level = x @ w.astype(x.dtype)
        above = np.concatenate([np.ones((len(x), 1)), 1.0 / (1.0 + np.exp(np.clip(t[None, :] - level[:, None], -40, 40))), np.zeros((len(x), 1))], axis=1)
        chance = np.maximum(above[np.arange(len(x)), rank] - above[np.arange(len(x)), rank + 1], 1e-12)
        slope = above * (1 - above)
        here, after = slope[np.arange(len(x)), rank], slope[np.arange(len(x)), rank + 1]
        by_level = -each * (here - after) / chance
        by_t = np.zeros(k)
        for j in range(k):
            by_t[j] = (each * np.where(rank == j + 1, here, 0.0) / chance).sum() - (each * np.where(rank == j, after, 0.0) / chance).sum()
        tail = by_t[::-1].cumsum()[::-1]
        gradient = np.concatenate([x.T @ by_level.astype(x.dtype) + penalty * w, [tail[0]], tail[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        values = values - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return values[: x.shape[1]], values[x.shape[1]] + np.concatenate([[0.0], np.cumsum(np.exp(values[x.shape[1] + 1 :]))])


def train(rated: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows (doc_id, text, grade); grades are whole numbers, rows without text or grade are left out."""
    picked = sample(rated.where("grade is not null and text <> ''").withColumn("grade", F.col("grade").cast("int")), "grade", settings.training_rows)
    x, y = vectors_of(picked, "grade", "int", settings.bits, settings.orders)
    grades = sorted(set(y))
    if len(grades) < 2:
        return Model(settings, grades, np.zeros(1 << settings.bits), np.zeros(0))
    scale = 1.0 / np.maximum(x.std(axis=0), 1e-3 / (1 << settings.bits)) / np.float32(np.sqrt(1 << settings.bits))
    centre = x.mean(axis=0)
    rank = np.searchsorted(grades, y)
    w, t = fit(((x - centre) * scale).astype(np.float32), rank, len(grades), settings.penalty, settings.rounds, settings.rate)
    w = w * scale
    return Model(settings, grades, w, t + w @ centre)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, expected_grade, tail_probability, kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: 2^bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        steps = np.diff(model.grades).astype(float)
        at = next((k for k, g in enumerate(model.grades[1:]) if g >= model.settings.least), None)
        for batch in chunks(batches):
            texts = as_bytes(batch.column("text"))
            tails = model.tails(texts)
            full = np.array([float(bool(t)) for t in texts])
            expected = full * (model.grades[0] if model.grades else 0) + tails @ steps
            tail = tails[:, at] if at is not None and tails.shape[1] else np.zeros(len(texts))
            if model.grades and model.grades[0] >= model.settings.least:
                tail = full
            yield pa.record_batch([batch.column("doc_id"), pa.array(expected), pa.array(tail), pa.array(tail >= model.settings.limit)],
                                  names=["doc_id", "expected_grade", "tail_probability", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, kept boolean")
