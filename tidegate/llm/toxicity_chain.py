"""Toxicity categories by a chain of linear models over words.

Categories come in a fixed order. The model of each sees the text's words and the probabilities of all earlier
categories. In training those are out-of-fold: predicted by models that did not see the row, so that later models learn
from errors like those they will meet; in prediction they come from the models fitted on all training rows.

Words are runs of letters and digits (other ASCII characters separate), A-Z lower-cased. A feature is a word's presence
anywhere in the whole text. The vocabulary has every word whose presence goes with some category, by log-likelihood
ratio over the training rows (``least_ratio`` or more), and that ``least_rows`` of them or more have. So it has at most
1 / least_rows as many words as the training rows have together; features are kept as (row, word) pairs.

Null and empty texts have no words; like all texts without a vocabulary word they get the models' base probabilities.
Repeated rows each get a row, an empty table gives none, other columns are left out. Rows with a null label in any
category are not trained on; without training rows all probabilities are 0.

The fit uses at most ``Settings.training_rows`` labelled rows, chosen by a hash of doc_id; prediction reads all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import as_bytes, chunks

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)), b" " * len(_SEPARATORS) + bytes(range(97, 123)))


@dataclass(frozen=True)
class Settings:
    training_rows: int = 8_000
    least_rows: int = 8
    least_ratio: float = 25.0
    folds: int = 5
    penalty: float = 1e-5
    rounds: int = 25
    limit: float = 0.3


@dataclass
class Model:
    settings: Settings
    categories: list[str]
    words: dict[bytes, int]
    weights: list[np.ndarray]

    def probabilities(self, texts: list[bytes | None]) -> np.ndarray:
        """texts x categories."""
        return chained(present(texts, self.words), self.weights)


@dataclass
class Features:
    """Rows of 0/1 word features, as the places of the ones, and of a few further columns that every row has."""

    row: np.ndarray
    col: np.ndarray
    words: int
    extra: np.ndarray

    def with_column(self, values: np.ndarray) -> Features:
        return Features(self.row, self.col, self.words, np.hstack([self.extra, values[:, None]]))

    def where(self, kept: np.ndarray) -> Features:
        ones = kept[self.row]
        return Features((np.cumsum(kept) - 1)[self.row[ones]], self.col[ones], self.words, self.extra[kept])

    def times(self, w: np.ndarray) -> np.ndarray:
        """Features times weights: those of the words, of the further columns, and the bias."""
        return np.bincount(self.row, w[self.col], len(self.extra)) + self.extra @ w[self.words : -1] + w[-1]

    def summed(self, v: np.ndarray) -> np.ndarray:
        """One number a row, added up by feature; the bias is in every row."""
        return np.concatenate([np.bincount(self.col, v[self.row], self.words), self.extra.T @ v, [v.sum()]])


def words_in(text: bytes | None) -> set[bytes]:
    return set(text.translate(_FOLD).split()) if text else set()


def present(texts: list[bytes | None], words: dict[bytes, int]) -> Features:
    known = words.keys()
    found = [sorted(words[w] for w in known & words_in(t)) for t in texts]
    return features_of(found, len(words))


def features_of(found: list[list[int]], words: int) -> Features:
    row = np.repeat(np.arange(len(found)), [len(x) for x in found])
    return Features(row, np.array([i for x in found for i in x], np.intp), words, np.zeros((len(found), 0)))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _solved(x: Features, curve: np.ndarray, ridge: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The Newton step by conjugate gradients, scaled by the diagonal: no matrix of words by words."""
    scale = np.concatenate([np.bincount(x.col, curve[x.row], x.words), (x.extra**2).T @ curve, [curve.sum()]]) + ridge
    step, rest = np.zeros(len(g)), g.copy()
    way = rest / scale
    now, goal = rest @ way, 1e-20 * (g @ (g / scale))
    for _ in range(10 * len(g)):
        if now <= goal or now == 0:
            break
        ahead = x.summed(curve * x.times(way)) + ridge * way
        by = now / (way @ ahead)
        step += by * way
        rest -= by * ahead
        before, now = now, rest @ (rest / scale)
        way = rest / scale + now / before * way
    return step


def fit(x: Features, y: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """Logistic regression with a bias (last weight) by Newton steps, halved while they make the fit worse."""
    ridge = np.full(x.words + x.extra.shape[1] + 1, penalty * len(y))
    ridge[-1] = 1e-6
    ridge += 1e-9

    def loss(w: np.ndarray) -> float:
        z = x.times(w)
        return float((np.logaddexp(0, z) - y * z).sum() + ridge @ (w * w) / 2)

    w = np.zeros(len(ridge))
    now = loss(w)
    for _ in range(rounds):
        p = logistic(x.times(w))
        step = _solved(x, p * (1 - p), ridge, x.summed(p - y) + ridge * w)
        after = loss(w - step)
        while after > now and np.abs(step).max() >= 1e-6:
            step /= 2
            after = loss(w - step)
        if after > now:
            break
        w, now = w - step, after
        if np.abs(step).max() < 1e-6:
            break
    return w


def chained(x: Features, weights: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(x.extra), len(weights)))
    for k, w in enumerate(weights):
        out[:, k] = logistic(x.times(w))
        x = x.with_column(out[:, k])
    return out


def fit_chain(x: Features, labels: np.ndarray, folds: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """One weight vector per category; earlier categories enter by their out-of-fold probabilities."""
    weights = []
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        weights.append(fit(x, y, settings.penalty, settings.rounds))
        out_of_fold = np.full(len(y), y.mean())
        for f in np.unique(folds):
            own = folds == f
            if (~own).any():
                w = fit(x.where(~own), y[~own], settings.penalty, settings.rounds)
                out_of_fold[own] = logistic(x.where(own).times(w))
        x = x.with_column(out_of_fold)
    return weights


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        found = [words_in(t) for t in as_bytes(batch.column("text"))]
        at = np.repeat(np.arange(batch.num_rows), [len(x) for x in found])
        yield pa.record_batch([pa.array([w for x in found for w in x], pa.binary()), batch.column("labels").take(pa.array(at))], names=["word", "labels"])


def train(labelled: DataFrame, categories: list[str], settings: Settings = Settings()) -> Model:
    """Fit on rows (doc_id, text, one 0/1 column per category); bound the rows beforehand with :func:`training_sample`."""
    labels = F.array(*(F.col(c).cast("int") for c in categories))
    rows = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", labels.alias("labels")).where(F.forall("labels", lambda v: v.isNotNull()))
    n, *positive = rows.agg(F.count("*"), *(F.sum(F.col("labels")[k]) for k in range(len(categories)))).first()
    if not n:
        return Model(settings, categories, {}, [np.array([-40.0] + [0.0] * k)[::-1] for k in range(len(categories))])
    tally = rows.select("text", "labels").mapInArrow(_word_rows, "word binary, labels array<int>").groupBy("word")
    tally = tally.agg(F.count("*").alias("n"), *(F.sum(F.col("labels")[k]).alias(f"p{k}") for k in range(len(categories)))).where(F.col("n") >= settings.least_rows)
    # 2 * log-likelihood ratio of presence against category, from the four counts.
    part = lambda a, row, col: F.when(a > 0, a * F.log(a * n / (row * col))).otherwise(0.0)
    ratio = F.lit(0.0)
    for k, pos in enumerate(positive):
        if 0 < pos < n:
            a, m = F.col(f"p{k}"), F.col("n")
            g = part(a, m, F.lit(pos)) + part(m - a, m, F.lit(n - pos)) + part(pos - a, n - m, F.lit(pos)) + part(n - m - pos + a, n - m, F.lit(n - pos))
            ratio = F.greatest(ratio, 2 * g)
    best = tally.select("word", ratio.alias("ratio")).where(F.col("ratio") >= settings.least_ratio).select("word").collect()
    words = {w: i for i, w in enumerate(sorted(bytes(r["word"]) for r in best))}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.keys()
        for batch in chunks(batches):
            found = [sorted(words[w] for w in known & words_in(t)) for t in as_bytes(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("labels"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "labels", "found"])

    got = sorted(rows.mapInArrow(features, "doc_id long, labels array<int>, found array<int>").collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    folds = np.array([(r["doc_id"] or 0) % settings.folds for r in got])
    x = features_of([r["found"] for r in got], len(words))
    return Model(settings, categories, words, fit_chain(x, np.array([r["labels"] for r in got]), folds, settings))


def training_sample(labels: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` rows of a table with doc_id, by a hash of doc_id."""
    n = labels.count()
    # Another hash than the one that later samples within these rows use.
    return labels.where(F.pmod(F.xxhash64(F.lit("labels"), "doc_id"), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, p_<category> for each, and toxic: the last category's probability reaches the limit."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its words are bounded by the training rows
    names = [f"p_{c}" for c in model.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches):
            p = model.probabilities(as_bytes(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array(p[:, -1] >= model.settings.limit)],
                                  names=["doc_id", *names, "toxic"])

    schema = ", ".join(["doc_id long", *(f"{c} double" for c in names), "toxic boolean"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` (all their columns) that the last category's model does not call toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches):
            p = model.probabilities(as_bytes(batch.column("text")))
            yield batch.filter(pa.array(p[:, -1] < model.settings.limit))

    return docs.mapInArrow(run, docs.schema)
