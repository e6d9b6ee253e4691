"""Best-fit packing by length patterns and non-negative least squares.

Documents are token ids plus an end id; only those longer than a sequence are cut, the first piece being the short one.
Patterns of up to three lengths that fill a sequence exactly are enumerated. How often each is used is fitted to the
histogram of lengths by non-negative least squares (accelerated projected gradient over the sparse pattern matrix),
rounded by error diffusion along neighbouring patterns, never beyond the pieces that exist. What is left of the
histogram is packed by best fit decreasing, working on counts of equal lengths. Only the histogram (as many entries as
a sequence has tokens) reaches the driver, whatever the input's size, and the plan's size depends on the sequence
length alone.

Pieces get their place from their rank among pieces of their length. A rank is the running number within the task that
tokenized it, plus what earlier tasks have of that length; so no length, however common, meets in one task.

Null and empty texts are documents of the end id alone. Repeated rows are packed each. An empty table gives no rows.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import chunks, crc, store
from tidegate.llm.tokens import END, encoder, vocabulary

SEQUENCE = 2048
ROUNDS = 300
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long"

Plan = list[tuple[int, tuple[int, ...]]]


def patterns(size: int, present: np.ndarray) -> np.ndarray:
    """All (a, b, c) with a >= b >= c > 0 and a + b + c = size, then all (a, b, 0), of lengths that are present; by a, b."""
    a, b = np.meshgrid(np.arange(size + 1), np.arange(size + 1), indexing="ij")
    c = size - a - b
    keep = (a >= b) & (b >= c) & (c >= 0) & (b > 0)
    found = np.stack([a[keep], b[keep], c[keep]], axis=1)
    return found[(present[found] | (found == 0)).all(axis=1)]


def fit(found: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimize |A x - histogram|^2, A being how often a pattern holds each length.

    Columns are scaled by the counts of their lengths first, so that common lengths and rare ones move alike.
    """
    size = len(histogram)
    if not len(found):
        return np.zeros(0)
    wanted = histogram.astype(float)
    wanted[0] = 0.0
    weight = 1.0 / np.sqrt(np.maximum(wanted, 1.0))
    weight[0] = 0.0
    scale = np.where(found > 0, wanted[found], np.inf).min(axis=1)
    total = lambda x: sum(np.bincount(found[:, k], x, size) for k in range(3))
    ahead = lambda x: weight * (total(scale * x) - wanted)
    back = lambda r: scale * sum((weight * r)[found[:, k]] for k in range(3))
    probe = np.ones(len(found))
    for _ in range(12):
        probe = back(weight * total(scale * probe))
        norm = np.linalg.norm(probe)
        if not norm:
            return np.zeros(len(found))
        probe /= norm
    step = 0.9 / norm
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(ahead(y)), 0.0)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return scale * x


def rounded(found: np.ndarray, x: np.ndarray, left: np.ndarray) -> Plan:
    """Whole repeat counts: the running sum of x, rounded, as far as the pieces ``left`` (changed) reach."""
    counts = np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0.0).astype(np.int64)
    plan: Plan = []
    for i in np.flatnonzero(counts):
        lengths = tuple(int(v) for v in found[i] if v)
        n = min([int(counts[i])] + [int(left[v]) // lengths.count(v) for v in set(lengths)])
        if n > 0:
            plan.append((n, lengths))
            for v in lengths:
                left[v] -= n
    return plan


def best_fit(left: np.ndarray, size: int) -> Plan:
    """Best fit decreasing over counts of equal lengths; sequences that hold the same lengths are handled together."""
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    done: Plan = []

    def put(n: int, held: tuple[int, ...]) -> None:
        room = size - sum(held)
        (done.append((n, held)) if room == 0 else open_.setdefault(room, []).append((n, held)))

    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                each = size // length
                if count >= each:
                    put(count // each, (length,) * each)
                    count %= each
                else:
                    put(1, (length,) * count)
                    count = 0
                continue
            n, held = open_[room].pop()
            if not open_[room]:
                del open_[room]
            used = min(n, count)
            if used < n:
                open_.setdefault(room, []).append((n - used, held))
            put(used, (*held, length))
            count -= used
    return done + [x for groups in open_.values() for x in groups]


def make_plan(histogram: np.ndarray) -> Plan:
    """(repeat count, lengths) for every sequence; each piece of the histogram is used once."""
    size = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    plan: Plan = [(int(left[size]), (size,))] if left[size] else []
    left[size] = 0
    found = patterns(size, left > 0)
    plan += rounded(found, fit(found, left), left)
    return plan + best_fit(left, size)


def slots(plan: Plan, size: int) -> tuple[np.ndarray, ...]:
    """The plan by length: key (length * 2^40 + first rank), repeat count, first sequence, offset of each run of ranks."""
    taken = np.zeros(size + 1, np.int64)
    rows, sequence = [], 0
    for n, lengths in plan:
        offset = 0
        for v in lengths:
            rows.append(((v << 40) + taken[v], sequence, offset))
            taken[v] += n
            offset += v
        sequence += n
    table = np.array(rows or [(0, 0, 0)], np.int64)
    table = table[np.argsort(table[:, 0])]
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def _pieces(path: str, size: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in chunks(batches):
            ids, begins = encoder(path).encode(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            rows = []
            for i, doc in enumerate(docs):
                own = np.append(ids[begins[i] : begins[i + 1]], end)
                head = len(own) % size or size
                edges = [0, *range(head, len(own) + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append((doc, k, a, b - a, crc(own[a:b]), seen[b - a]))
                    seen[b - a] += 1
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.record_batch(
                [*arrays, pa.array([task] * len(rows), pa.int32()), pa.array([int(r) for r in columns[5]], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, size: int = SEQUENCE, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = store(rows.mapInArrow(_pieces(tokenizer or vocabulary(), size, end), PIECES), "pieces")
    # One row per task and length that occurs there; the histogram has at most ``size`` rows.
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    histogram = np.zeros(size + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    table = spark.sparkContext.broadcast(slots(make_plan(histogram), size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = table.value
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            key = (length << 40) + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            yield pa.record_batch(
                [*(batch.column(c) for c in ("doc_id", "piece", "start")), pa.array(length), batch.column("ids_crc32"),
                 pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(by_task, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
