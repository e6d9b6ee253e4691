"""Language identification in two levels: the language family first, then the language within its family.

Families are told apart by one linear support vector machine each (against all others), languages of a family by one
machine for each pair of them. Features are hashed byte n-grams of the lower-cased text. The family with the greatest
margin wins; within it, the language with the most won pairs, ties by the sum of margins, then by name.

A language that the table of families does not name is a family of its own. ``score`` is the logistic value of the
family's margin times that of the weakest pair that the language won (1 where there is nothing to tell apart).
Texts that are null or have no letter are ``und`` with score 0. Without labelled rows, all others are ``und`` too.
Repeated rows each get a row, an empty table gives none, and columns besides ``doc_id`` and ``text`` are not read for
predictions.

Models are fitted on the driver on at most ``Settings.training_rows`` rows, drawn evenly over the languages by a hash
of doc_id; prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import hashed
from tidegate.llm.shared import as_bytes, chunks

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he"),
    "indo_aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
}
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    training_rows: int = 2400
    bits: int = 12
    orders: tuple[int, ...] = (1, 2, 3)
    cost: float = 1.0
    rounds: int = 30
    slope: float = 2.0
    slack: float = 0.05
    families: dict[str, tuple[str, ...]] = field(default_factory=lambda: FAMILIES)


@dataclass
class Model:
    """Weights (functions x buckets) and biases of all machines, and what each of them tells apart."""

    settings: Settings
    families: list[tuple[str, list[str]]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    biases: np.ndarray
    #: The least score of a labelled row whose language was found; 0 without any.
    least: float = 0.0

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float]]:
        """(language, score) by text; texts must be lower-cased."""
        if not self.families:
            return [(UNKNOWN, 0.0)] * len(texts)
        return self.judge(hashed.scores(texts, self.weights, self.settings.orders) + self.biases)

    def judge(self, margins: np.ndarray) -> list[tuple[str, float]]:
        """(language, score) by margins of all machines."""
        sure = 1.0 / (1.0 + np.exp(-self.settings.slope * margins))
        n = len(self.families) if len(self.families) > 1 else 0
        out = []
        for m, s in zip(margins, sure):
            k = int(np.argmax(m[:n])) if n else 0
            languages, score = self.families[k][1], float(s[k]) if n else 1.0
            won = {x: [0, 0.0, 1.0] for x in languages}
            for j, (a, b) in enumerate(self.pairs, n):
                if a in won:
                    x, sign = (a, 1) if m[j] >= 0 else (b, -1)
                    won[x][0] += 1
                    won[a][1] += m[j]
                    won[b][1] -= m[j]
                    won[x][2] = min(won[x][2], float(s[j] if sign > 0 else 1 - s[j]))
            best = min(won, key=lambda x: (-won[x][0], -won[x][1], x))
            out.append((best, score * won[best][2]))
        return out


def support_vectors(x: np.ndarray, y: np.ndarray, cost: float, rounds: int) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by dual coordinate descent; y is +1 or -1. Classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    each = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    slack = 1.0 / (2 * cost * each)
    square = (x * x).sum(axis=1) + slack
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ w) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w[:-1], float(w[-1])


def sample(rows: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` rows at most, evenly over the values of ``label``, chosen by a hash of doc_id."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    share = most // max(len(counts), 1)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == value) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, share / n) * (1 << 30))))
    return rows.where(keep)


def vectors_of(rows: DataFrame, label: str, kind: str, bits: int, orders: tuple[int, ...]) -> tuple[np.ndarray, list]:
    """Vectors and labels of sampled rows (text lower-cased or not, as it stands), in the order of doc_id, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            for i in range(0, chunk.num_rows, 256):
                batch = chunk.slice(i, 256)
                got = hashed.vectors(as_bytes(batch.column("text")), bits, orders)
                yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array([v.tobytes() for v in got], pa.binary())], names=["doc_id", "label", "v"])

    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"), "text")
    got = rows.mapInArrow(run, f"doc_id long, label {kind}, v binary").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    x = np.empty((got.num_rows, 1 << bits), np.float32)
    for i, v in enumerate(got.column("v")):
        x[i] = np.frombuffer(v.as_buffer(), np.float32)
    return x, got.column("label").to_pylist()


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on rows (doc_id, text, lang) with a language and a letter."""
    picked = sample(docs.where("lang is not null and text is not null"), "lang", settings.training_rows)
    picked = picked.where(F.col("text").rlike(r"\p{L}")).withColumn("text", F.lower("text"))
    x, y = vectors_of(picked, "lang", "string", settings.bits, settings.orders)
    languages = sorted(set(y))
    named = {c: f for f, codes in settings.families.items() for c in codes}
    families: dict[str, list[str]] = {}
    for code in languages:
        families.setdefault(named.get(code, code), []).append(code)
    listed = sorted(families.items())
    scale = 1.0 / np.maximum(x.std(axis=0), 1e-3 / (1 << settings.bits)) if len(x) else np.ones(1 << settings.bits)
    centre = x.mean(axis=0) if len(x) else np.zeros(1 << settings.bits)
    z = ((x - centre) * scale / np.float32(np.sqrt(1 << settings.bits))).astype(np.float32)
    y = np.array(y)
    machines, pairs = [], []
    if len(listed) > 1:
        for _, codes in listed:
            machines.append(support_vectors(z, np.where(np.isin(y, codes), 1.0, -1.0), settings.cost, settings.rounds))
    for _, codes in listed:
        for a, b in combinations(codes, 2):
            own = np.isin(y, (a, b))
            machines.append(support_vectors(z[own], np.where(y[own] == a, 1.0, -1.0), settings.cost, settings.rounds))
            pairs.append((a, b))
    weights = np.array([w * scale / np.sqrt(1 << settings.bits) for w, _ in machines]).reshape(len(machines), 1 << settings.bits)
    biases = np.array([b for _, b in machines]) - weights @ centre
    model = Model(settings, listed, pairs, weights, biases)
    if len(y):
        model.least = min((score for (found, score), known in zip(model.judge(x @ weights.T + biases), y) if found == known), default=0.0)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: machines x 2^bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            letters = batch.column("letters").to_pylist()
            got = [p if ok else (UNKNOWN, 0.0) for p, ok in zip(shared.value.predict(as_bytes(batch.column("text"))), letters)]
            yield pa.record_batch([batch.column("doc_id"), pa.array([p[0] for p in got], pa.string()), pa.array([p[1] for p in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float | None = None) -> DataFrame:
    """Rows of ``docs`` (all their columns) whose language is known with a score of ``least`` or more; no null ids.

    By default the limit is a little (``Settings.slack``) below the least score of a labelled row that was identified.
    """
    least = model.least * (1 - model.settings.slack) if least is None else least
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            got = shared.value.predict(as_bytes(batch.column("lowered")))
            known = pa.array([p[0] != UNKNOWN and p[1] >= least for p in got], pa.bool_())
            yield batch.drop_columns(["lowered"]).filter(known)

    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    return rows.withColumn("lowered", F.lower("text")).mapInArrow(run, docs.schema)
