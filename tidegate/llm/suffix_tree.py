"""Language-model scores from a probabilistic suffix tree, with a unigram model of words beside it.

A text is the sequence of its words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) and one end. The tree reads it as bytes:
words joined by one space, then a line feed, which no word holds; so a sequence of words has one spelling and its
probability is that of the spelling. Contexts are up to ``depth`` preceding bytes; before a text stand line feeds.

Counting covers the whole training corpus: tasks count (context, next byte) of full depth and Spark adds them up;
shorter contexts are sums of longer ones. A context becomes a state of the tree

* if it occurs ``least_count`` times or more, whatever the size of the corpus, and
* if its next-byte distribution diverges from that of its longest proper suffix: the sum of n * ln(ratio) reaches
  ln(N) / 2 for each distinct next byte. Suffixes of states are states too.

The distribution of a state is smoothed with that of its suffix: a share of T / (N + T) goes there, T being the
number of distinct next bytes. The empty context is smoothed with 1 / 256. A byte is scored in the longest state that
ends before it.

So the tree grows with the corpus. It stays a table: from the empty context up, each level's probabilities are joined
to the next one's, which gives one for each distinct (context, next byte) of full depth. Those that make up
``head_share`` of all positions or more (at most 1 / head_share, whatever the input) are broadcast and looked up in
tasks; the others are joined. A code has eight bytes, so ``depth`` is 7 at most.

Words of the unigram model that make up ``common_share`` of the tokens or more (at most 1 / common_share words) are
looked up in tasks; the others are joined.

Null and empty texts, and texts without a word, are one end. Without training rows every byte has probability 1 / 256
and every count is 0. Repeated rows each get a row; an empty table gives none; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import as_bytes, chunks, store

BYTES = 256
#: (context, next byte) counts that a task gathers before it passes them on.
GATHER = 1_500_000


@dataclass(frozen=True)
class Settings:
    depth: int = 5
    least_count: int = 50
    head_share: float = 5e-7
    common_share: float = 5e-7
    prior: float = 0.1


@dataclass
class Tree:
    """A small tree in memory: states by level (sorted contexts) and their next bytes (sorted context * 256 + next)."""

    depth: int
    start: np.ndarray
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    onward: list[np.ndarray]
    nexts: list[np.ndarray]
    counts: list[np.ndarray]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each code (depth context bytes, then the byte)."""
        p = self.start[(codes & np.uint64(255)).astype(np.intp)]
        inside = np.ones(len(codes), bool)
        for k in range(self.depth):
            mask = np.uint64((1 << (8 * (k + 2))) - 1)
            inside = inside & (len(self.contexts[k]) > 0)
            at, found = _find(self.contexts[k], (codes & mask) >> np.uint64(8), inside)
            inside = found
            if not inside.any():
                break
            pair, kept = _find(self.nexts[k], codes & mask, inside)
            n = np.where(kept, self.counts[k][pair] if len(self.counts[k]) else 0.0, 0.0)
            p = np.where(inside, (n + self.onward[k][at] * p) / self.totals[k][at], p)
        return np.log10(p)


def _find(keys: np.ndarray, wanted: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(wanted), np.intp)
    if not len(keys):
        return at, np.zeros(len(wanted), bool)
    some = np.flatnonzero(where)
    some = some[np.argsort(wanted[some])]  # in ascending order, each search begins near the last one
    at[some] = np.minimum(np.searchsorted(keys, wanted[some]), len(keys) - 1)
    return at, where & (keys[at] == wanted)


def spelled(text: bytes | None) -> bytes:
    return b" ".join(text.lower().split()) if text else b""


def codes_of(texts: list[bytes | None], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of every spelled text and its end: the code of its context and itself; and where each text's begin."""
    return codes_of_spelled([spelled(t) for t in texts], depth)


def codes_of_spelled(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`codes_of` of texts that are spelled already."""
    pad = b"\n" * depth
    data = np.frombuffer(pad.join([b"", *(s + b"\n" for s in texts)]) if texts else b"", np.uint8)
    lengths = np.array([len(s) + 1 for s in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    n = len(data) - depth
    if n <= 0:
        return np.zeros(0, np.uint64), begins
    code = data[:n].astype(np.uint64)
    for k in range(1, depth + 1):
        code = (code << np.uint64(8)) | data[k : n + k]
    keep = np.ones(n, bool)
    for k in range(depth):  # positions of the padding between texts
        gaps = begins[1:-1] + depth * np.arange(len(texts) - 1) + k
        keep[gaps] = False
    return code[keep], begins


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, keys = pd.factorize(np.concatenate([p[0] for p in parts]))
    return keys, np.bincount(code, np.concatenate([p[1] for p in parts])).astype(np.int64)


def context_counts(docs: DataFrame, depth: int) -> DataFrame:
    """(code, n, seen): how often each byte follows each context of full depth in training texts, and in all texts.

    A column ``training`` says which texts are for training; without it all are.
    """
    docs = docs.select("text", F.coalesce(F.col("training"), F.lit(False)).alias("training") if "training" in docs.columns else F.lit(True).alias("training"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, n: np.ndarray, own: bool) -> pa.RecordBatch:
            n = n.astype(np.int64)
            return pa.record_batch([pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(n if own else np.zeros_like(n)), pa.array(n)], names=["code", "n", "seen"])

        held: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {True: [], False: []}
        for batch in chunks(batches):
            codes, begins = codes_of(as_bytes(batch.column("text")), depth)
            training = np.repeat(batch.column("training").to_numpy(zero_copy_only=False).astype(bool), np.diff(begins))
            for own in (True, False):
                number, keys = pd.factorize(codes[training == own])
                if len(keys):
                    held[own].append((keys, np.bincount(number, minlength=len(keys))))
            if sum(len(k) for parts in held.values() for k, _ in parts) > GATHER:
                held = {own: [_added(parts)] if parts else [] for own, parts in held.items()}
                if sum(len(parts[0][0]) for parts in held.values() if parts) > GATHER // 2:
                    for own, parts in held.items():
                        if parts:
                            yield out(*parts.pop(), own)
        for own, parts in held.items():
            if parts:
                yield out(*_added(parts), own)

    counted = docs.mapInArrow(run, "code long, n long, seen long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def word_lists(texts: pa.Array) -> pa.ListArray:
    """Words of each text, lower-cased; null and empty texts have none."""
    return words_of_spelled([spelled(t) for t in as_bytes(texts)])


def words_of_spelled(texts: list[bytes]) -> pa.ListArray:
    return pc.split_pattern(pa.array(texts, pa.binary()).cast(pa.string()), " ")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            counted = word_lists(batch.column("text")).flatten().value_counts()
            words = counted.field(0)
            full = pc.not_equal(words, "")
            yield pa.record_batch([words.filter(full), counted.field(1).cast(pa.int64()).filter(full)], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _low(column: str, size: int) -> Column:
    """The last ``size`` bytes of a code."""
    return F.col(column).bitwiseAND(F.lit((1 << (8 * size)) - 1))


def levels_of(counts: DataFrame, depth: int) -> list[DataFrame]:
    """levels[k]: (code, n), code being k context bytes and the next byte."""
    levels = [counts.select("code", "n")]
    for k in range(depth - 1, -1, -1):
        levels.insert(0, store(levels[0].groupBy(_low("code", k + 1).alias("code")).agg(F.sum("n").alias("n")), "level"))
    return levels


def states_of(levels: list[DataFrame], settings: Settings) -> dict[int, DataFrame]:
    """By context length, the states of the tree: (context, total, kinds)."""
    context = F.shiftrightunsigned("code", 8).alias("context")
    depth, kept = settings.depth, {}
    levels = [x.where("n > 0") for x in levels]
    for k in range(depth, 0, -1):
        level = levels[k].select("code", context, "n")
        sums = level.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        sums = sums.where(F.col("total") >= settings.least_count)
        shorter = levels[k - 1].select(F.col("code").alias("short"), F.col("n").alias("short_n"), F.shiftrightunsigned("code", 8).alias("short_context"))
        short_sums = shorter.groupBy("short_context").agg(F.sum("short_n").alias("short_total"))
        rows = level.join(sums, "context").withColumn("short", _low("code", k))
        rows = rows.join(shorter, "short").join(short_sums, "short_context")
        gain = F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("short_n") / F.col("short_total")))
        states = rows.groupBy("context").agg(F.sum(gain).alias("gain"), F.first("total").alias("total"), F.first("kinds").alias("kinds"))
        chosen = states.where(F.col("gain") >= F.log("total") / 2 * F.col("kinds")).select("context")
        if k < depth:  # suffixes of longer states
            chosen = chosen.union(kept[k + 1].select(_low("context", k).alias("context"))).distinct()
        kept[k] = store(sums.join(chosen, "context"), "states")
    return kept


def code_logs(counts: DataFrame, settings: Settings) -> DataFrame:
    """(code, seen, log): log10 of the tree's probability for each code of :func:`context_counts`, from joins alone."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    if not total:
        return counts.select("code", "seen", F.lit(float(-np.log10(BYTES))).alias("log"))
    levels = levels_of(counts, settings.depth)
    states = states_of(levels, settings)
    kinds = levels[0].where("n > 0").count()
    p = levels[0].select("code", ((F.col("n") + F.lit(kinds / BYTES)) / F.lit(float(total + kinds))).alias("p"))
    levels[-1] = counts  # with ``seen``
    for k in range(1, settings.depth + 1):
        rows = levels[k].withColumn("short", _low("code", k)).withColumn("context", F.shiftrightunsigned("code", 8))
        rows = rows.join(p.select(F.col("code").alias("short"), "p"), "short").join(states[k], "context", "left")
        mixed = (F.col("n") + F.col("kinds") * F.col("p")) / (F.col("total") + F.col("kinds"))
        rows = rows.withColumn("p", F.coalesce(mixed, "p"))
        p = rows.select("code", "p") if k < settings.depth else rows.select("code", "seen", F.log10("p").alias("log"))
    return p


def grow(counts: DataFrame, settings: Settings) -> Tree:
    """The whole tree in memory, from (code, n) of full depth: to look into small ones, scoring does not use it."""
    depth = settings.depth
    total = counts.agg(F.sum("n")).first()[0] or 0
    start = np.full(BYTES, 1.0 / BYTES)
    empty = lambda kind: [np.zeros(0, kind) for _ in range(depth)]
    tree = Tree(depth, start, empty(np.uint64), empty(float), empty(float), empty(np.uint64), empty(float))
    if not total:
        return tree
    levels = levels_of(counts, depth)
    first = np.zeros(BYTES)
    for r in levels[0].collect():
        first[r["code"]] = r["n"]
    kinds = (first > 0).sum()
    tree.start = (first + kinds / BYTES) / (total + kinds)
    context = F.shiftrightunsigned("code", 8).alias("context")
    for k, kept in sorted(states_of(levels, settings).items()):
        states = kept.toPandas().sort_values("context")
        rows = levels[k].where("n > 0").select("code", context, "n").join(kept.select("context"), "context").select("code", "n").toPandas()
        nexts, numbers = rows["code"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(float)
        tree.nexts[k - 1], tree.counts[k - 1] = nexts[np.argsort(nexts)], numbers[np.argsort(nexts)]
        tree.contexts[k - 1] = states["context"].to_numpy(np.uint64)
        tree.totals[k - 1] = (states["total"] + states["kinds"]).to_numpy(float)
        tree.onward[k - 1] = states["kinds"].to_numpy(float)
    return tree


def score(docs: DataFrame, training: Column, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, train_tokens, base_score, score. ``training`` says which rows to learn from."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", training.alias("training"))
    corpus = rows.where("training")
    logs = store(code_logs(store(context_counts(rows, settings.depth), "contexts"), settings), "logs")
    often = settings.head_share * (logs.agg(F.sum("seen")).first()[0] or 0)
    frequent = logs.where(F.col("seen") >= often).select("code", "log").toPandas()  # at most 1 / head_share codes
    order = np.argsort(frequent["code"].to_numpy(np.int64).view(np.uint64))
    head = spark.sparkContext.broadcast((frequent["code"].to_numpy(np.int64).view(np.uint64)[order], frequent["log"].to_numpy(float)[order]))
    words = store(word_counts(corpus), "words")
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = corpus.count()
    n_train, kinds = n_words + ends, distinct + (1 if ends else 0)
    common = words.where(F.col("n") >= settings.common_share * max(n_train, 1))
    table = {r["word"]: r["n"] for r in common.toLocalIterator()}  # at most 1 / common_share words
    known = spark.sparkContext.broadcast(table)
    prior, floor = settings.prior, float(np.log10(n_train + settings.prior * (kinds + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        counts = known.value
        for batch in chunks(batches):
            spelling = [spelled(t) for t in as_bytes(batch.column("text"))]
            codes, begins = codes_of_spelled(spelling, settings.depth)
            number, keys = pd.factorize(codes)
            at, found = _find(head.value[0], keys, np.ones(len(keys), bool))
            in_head = found[number]
            score_of = np.where(found, head.value[1][at], 0.0) if len(head.value[1]) else np.zeros(len(keys))
            scores = np.add.reduceat(score_of[number], begins[:-1]) if batch.num_rows else np.zeros(0)
            code_ends = np.concatenate([[0], np.cumsum(np.add.reduceat(~in_head, begins[:-1], dtype=np.int64))]) if batch.num_rows else np.zeros(1)
            rare_codes = pa.ListArray.from_arrays(pa.array(code_ends.astype(np.int32)), pa.array(codes[~in_head].view(np.int64)))
            lists = words_of_spelled(spelling)
            offsets = lists.offsets.to_numpy()
            coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            offsets = offsets - offsets[0]
            # Through numpy: to_pylist makes a scalar of each word first.
            distinct_words = coded.dictionary.to_numpy(zero_copy_only=False)
            given = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
            of_word = np.fromiter((counts.get(w, -1) for w in distinct_words), np.int64, len(distinct_words))
            of_word[~given] = 0
            code = coded.indices.to_numpy(zero_copy_only=False)
            count = of_word[code]
            full = given[code]
            light = count < 0
            logs = np.where(light | ~full, 0.0, np.log10(np.maximum(count, 0) + prior))
            per_doc = lambda v: np.add.reduceat(v, offsets[:-1]) if len(v) else np.zeros(0)  # noqa: E731  every text has one entry at least
            rare = pa.DictionaryArray.from_arrays(pa.array(code[light]), coded.dictionary).cast(pa.string())
            rare_ends = np.concatenate([[0], np.cumsum(per_doc(light.astype(np.int64)))]).astype(np.int32)
            n = batch.num_rows
            yield pa.record_batch(
                [pa.array(row + np.arange(n)), batch.column("doc_id"), batch.column("training"), pa.array(per_doc(full.astype(np.int64)) + 1),
                 pa.array(per_doc((full & ~light).astype(np.int64))), pa.array(per_doc(logs)), pa.array(scores), pa.ListArray.from_arrays(pa.array(rare_ends), rare), rare_codes],
                names=["row", "doc_id", "training", "n_tokens", "n_common", "logs", "score", "rare", "codes"])
            row += n

    schema = "row long, doc_id long, training boolean, n_tokens long, n_common long, logs double, score double, rare array<string>, codes array<long>"
    scored = store(rows.mapInArrow(run, schema), "scored")
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    counts = words.where(F.col("n") < settings.common_share * max(n_train, 1))
    rare = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(prior))).alias("rare_logs"))
    tail = logs.where(F.col("seen") < often).select("code", "log")
    tail = scored.select("row", F.explode("codes").alias("code")).join(tail, "code").groupBy("row").agg(F.sum("log").alias("tail"))
    nothing = F.lit(0)
    base = F.col("logs") + F.coalesce("rare_logs", nothing) + F.log10(F.lit(float(ends + prior))) - F.col("n_tokens") * F.lit(floor)
    return scored.drop("rare", "codes").join(rare, "row", "left").join(tail, "row", "left").select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", nothing) + (1 if ends else 0)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce("tail", nothing)).alias("score"))
