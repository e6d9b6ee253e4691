"""Alignment of two tokenizers' ids by the byte offsets where both have a token end.

A is a byte-level BPE vocabulary, applied to a space and the text; B a sentencepiece model, which adds the space itself.
Per document a dictionary maps the cumulative ends of A's tokens to their indices, another those of B. The intersection
of their keys, sorted, slices both id lists into groups. Within a group no inner end is common, so its links (pairs of
tokens whose bytes overlap) are expanded by walking its ends: p tokens of A and q of B have p + q - 1 links.

Neither vocabulary has a token that goes on after a single space, so both have a token end before each. Texts are cut
there, and a part's groups and links are found once while the part is in a bounded memory. Texts with other white space,
or with spaces in a row, are one part.

How often an id pair is linked in the whole corpus is counted by one shuffle of partial counts. Documents then look their
pairs up: counts of the most frequent pairs, ``most_head`` at most, are broadcast; all other pairs are joined with the
table of counts. So no result depends on that number.

Strings of special tokens are plain text. Null and empty texts, and texts whose tokens' bytes do not give the space and
the text back (B normalizes or cannot spell them), have no tokens: zeros and no groups. Rows that repeat a doc_id, and null
ids, all stay. An empty table gives no rows. Other columns are left out. A text is worked on as a whole.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import chunks, store
from tidegate.llm.tokens import _ODD, Encoder, _byte_letters, _gather

MOST_HEAD = 1_000_000
#: Parts that a Python worker remembers; above it the memory is emptied.
CACHE_PARTS = 220_000
#: Bytes of text that a task works on at once.
CHUNK = 2 << 20
#: Parts that are learned at once.
LEARNED = 16_384
_SPACE = "▁".encode()

ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>"
_COUNTS = "n_a", "n_b", "n_groups", "n_links"


def vocabularies() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class _Spelling:
    """Bytes of each id, in a row."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        return _gather(self.flat, self.starts[ids], self.lengths[ids]).tobytes()


def _piece_bytes(model: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.encode().replace(_SPACE, b" ")


class _Found:
    """Tokens, groups and links of parts, all parts' entries in a row."""

    NAMES = ("a", "b", "size_a", "size_b", "pairs")

    def __init__(self):
        self.flat = {n: np.zeros(0, np.int64 if n == "pairs" else np.int32) for n in self.NAMES}
        self.ends = {n: np.zeros(1, np.int64) for n in self.NAMES}
        self.texts: list[bytes] = []  # groups as text, each with its semicolon
        self.sound = np.zeros(0, bool)  # whether the tokens' bytes are the part's

    def add(self, values: dict[str, np.ndarray], lengths: dict[str, np.ndarray], texts: list[bytes], sound: np.ndarray) -> None:
        for n in self.NAMES:
            self.flat[n] = np.append(self.flat[n], values[n].astype(self.flat[n].dtype))
            self.ends[n] = np.append(self.ends[n], self.ends[n][-1] + np.cumsum(lengths[n]))
        self.texts += texts
        self.sound = np.append(self.sound, sound)

    def counts(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.ends[name][at + 1] - self.ends[name][at]

    def take(self, name: str, at: np.ndarray) -> np.ndarray:
        return _gather(self.flat[name], self.ends[name][at], self.counts(name, at))


class Aligner:
    """Both tokenizers of a worker, with the bytes of their tokens and the parts that were seen."""

    def __init__(self, path_a: str, path_b: str, cache_parts: int = CACHE_PARTS):
        self.a = Encoder(path_a, cache_parts=cache_parts // 8, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in _byte_letters().items()}
        tokenizer = self.a.tokenizer
        names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        self.spelling_a = _Spelling([bytes(map(byte_of.__getitem__, n)) if all(c in byte_of for c in n) else n.encode() for n in names])
        pieces = [_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        self.spelling_b = _Spelling(pieces)
        self.space = [self.b.piece_to_id("▁")]
        if any(b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError("texts cannot be cut at spaces: a piece goes on after one")
        self.decimals = _Spelling([b"%d" % i for i in range(max(len(names), len(pieces)))])
        self.cache_parts = cache_parts
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.found = _Found()

    def _learn(self, parts: list[str], found: _Found) -> None:
        """Add what is to know of parts; each stands for a space and itself."""
        spelled = [b" " + p.encode() for p in parts]
        a, begins = self.a.encode(pa.array([" " + p for p in parts], pa.large_string()))
        a, n_a = a.astype(np.int64), np.diff(begins)
        lists = [x if p else self.space for p, x in zip(parts, self.b.encode(parts, num_threads=1))]
        n_b = np.fromiter(map(len, lists), np.int64, len(lists))
        b = np.fromiter(chain.from_iterable(lists), np.int64, int(n_b.sum()))
        # Parts that either side spells otherwise have no tokens.
        sound = np.ones(len(parts), bool)
        for own, n, spelling in ((a, n_a, self.spelling_a), (b, n_b, self.spelling_b)):
            joined = spelling.join(own)
            ends = np.append(0, np.cumsum(spelling.lengths[own]))[np.append(0, np.cumsum(n))].tolist()
            sound &= [joined[x:y] == t for x, y, t in zip(ends, ends[1:], spelled)]
        a, b = a[np.repeat(sound, n_a)], b[np.repeat(sound, n_b)]
        n_a, n_b = np.where(sound, n_a, 0), np.where(sound, n_b, 0)

        size_a, size_b, link_a, link_b = align(np.cumsum(self.spelling_a.lengths[a]), np.cumsum(self.spelling_b.lengths[b]))
        # Each part ends with a group, so a part's groups are those up to its last token of A.
        n_groups = np.diff(np.searchsorted(np.cumsum(size_a), np.cumsum(n_a), side="right"), prepend=0)
        n_links = np.where(sound, n_a + n_b - n_groups, 0)
        text, ends = groups_text(self.decimals, a, b, size_a, size_b)
        ends = np.append(0, ends)[np.append(0, np.cumsum(n_groups))].tolist()
        values = {"a": a, "b": b, "size_a": size_a, "size_b": size_b, "pairs": (a[link_a] << 32) + b[link_b]}
        lengths = {"a": n_a, "b": n_b, "size_a": n_groups, "size_b": n_groups, "pairs": n_links}
        found.add(values, lengths, [text[x:y] for x, y in zip(ends, ends[1:])], sound)

    def documents(self, texts: pa.Array) -> Iterator[tuple[_Found, np.ndarray] | None]:
        """For each text its parts' entries: where they are, and which; None for texts without tokens."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).astype(bool)
        # The text begins with a space for both, so white space at its start follows one.
        odd |= pc.match_substring_regex(texts, r"\A[ \n]").to_numpy(zero_copy_only=False).astype(bool)
        lists = pc.split_pattern(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts), " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        parts = coded.dictionary.to_pylist()
        new = [p for p in parts if p not in self.known]
        if len(self.known) + len(new) > self.cache_parts:
            self._forget()
            new = parts
        for start in range(0, len(new), LEARNED):
            self._learn(new[start : start + LEARNED], self.found)
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        at = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        for i in range(len(texts)):
            found, own = self.found, at[offsets[i] : offsets[i + 1]]
            if odd[i]:
                found, own = _Found(), np.zeros(1, np.int64)
                self._learn([texts[i].as_py()], found)
            yield (found, own) if not empty[i] and found.sound[own].all() else None


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the groups in tokens of A and of B, and the links' indices into A and into B.

    The ends are cumulative byte offsets of tokens that spell the same bytes, none of them empty.
    """
    index_a = {end: i for i, end in enumerate(ends_a.tolist())}
    index_b = {end: i for i, end in enumerate(ends_b.tolist())}
    common = sorted(index_a.keys() & index_b.keys())
    last_a = np.fromiter(map(index_a.__getitem__, common), np.int64, len(common))
    last_b = np.fromiter(map(index_b.__getitem__, common), np.int64, len(common))
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    # Links of a group: one for each end in it, of A's and B's tokens in order, the common one counted once.
    inner = np.ones(len(ends_b), bool)
    inner[last_b] = False
    at = np.concatenate([ends_a, ends_b[inner]])
    at.sort()
    return size_a, size_b, np.searchsorted(ends_a, at), np.searchsorted(ends_b, at)


def _positions(first: np.ndarray, other: np.ndarray, other_before: bool) -> np.ndarray:
    """Places of one side's tokens where groups are written A's tokens first, then B's."""
    ahead = np.cumsum(other) - (0 if other_before else other)
    return np.arange(int(first.sum())) + np.repeat(ahead, first)


def groups_text(decimals: _Spelling, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;``, the decimal ids of the groups, and where the text of each group ends."""
    ids = np.empty(len(a) + len(b), np.int64)
    marks = np.full(len(ids), ord(","), np.uint8)
    at_a, at_b = _positions(size_a, size_b, False), _positions(size_b, size_a, True)
    ids[at_a], ids[at_b] = a, b
    last_b = at_b[np.cumsum(size_b) - 1]
    marks[at_a[np.cumsum(size_a) - 1]] = ord("|")
    marks[last_b] = ord(";")
    lengths = decimals.lengths[ids]
    out = np.empty(int(lengths.sum()) + len(ids), np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    digit = np.ones(len(out), bool)
    digit[ends] = False
    out[digit] = _gather(decimals.flat, decimals.starts[ids], lengths)
    out[ends] = marks
    return out.tobytes(), ends[last_b] + 1


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    """The worker's aligner for two vocabulary files."""
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, groups): per document its groups, each with the ids ``a`` and ``b``."""
    paths = paths or vocabularies()
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            lists = []
            for own in aligner(paths).documents(batch.column("text")):
                if own is None:
                    lists.append([])
                    continue
                found, at = own
                a, b = (np.split(found.take(n, at), np.cumsum(found.take(f"size_{n}", at))[:-1]) for n in "ab")
                lists.append([{"a": x, "b": y} for x, y in zip(a, b)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(lists, kind)], names=["doc_id", "groups"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def _trim() -> None:
    """Give memory that is free back to the system; a worker is one of several on its machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def _aligned(paths: tuple[str, str]):
    """Rows of ALIGNED: ``pairs`` are the links as A's id times 2^32 plus B's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in chunks(batches, most=CHUNK):
            counts, hashes, pairs = [], [], []
            for own in aligner(paths).documents(batch.column("text")):
                if own is None:
                    counts.append((0, 0, 0, 0))
                    hashes.append("")
                    pairs.append(np.zeros(0, np.int64))
                    continue
                found, at = own
                counts.append([int(found.counts(n, at).sum()) for n in ("a", "b", "size_a", "pairs")])
                hashes.append(hashlib.sha256(b"".join([found.texts[i] for i in at.tolist()])[:-1]).hexdigest())
                pairs.append(found.take("pairs", at))
            n = batch.num_rows
            ends = np.cumsum([0, *map(len, pairs)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*pairs, np.zeros(0, np.int64)])))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            yield pa.record_batch([pa.array(np.arange(row, row + n)), batch.column("doc_id"), *columns, pa.array(hashes, pa.string()), lists],
                                  names=["row", "doc_id", *_COUNTS, "groups_sha256", "pairs"])
            row += n
            _trim()

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): links of each id pair in the corpus, and whether no pair with its id of B has more."""
    n = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    n = store(n.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), "pairs")
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    # One row for each id of B.
    return n.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_sums(aligned: DataFrame, counts: DataFrame, most_head: int) -> DataFrame:
    """(row, n_best, count_sum) of documents with links."""
    # The least count that at most ``most_head`` pairs reach; one row for each of the highest counts.
    least, held = None, 0
    for n, pairs in counts.groupBy("n").count().orderBy(F.desc("n")).limit(most_head + 1).collect():
        held += pairs
        if held > most_head:
            break
        least = n
    links = aligned.select("row", F.explode("pairs").alias("pair"))
    head = F.broadcast(counts.where(F.col("n") >= least) if least is not None else counts.limit(0))
    sums = links.join(head, "pair").groupBy("row").agg(F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))
    if held > most_head:
        others = links.join(head, "pair", "left_anti").groupBy("row", "pair").agg(F.count("*").alias("links"))
        rare = counts.where(F.col("n") < least) if least is not None else counts
        more = others.join(rare, "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
        sums = sums.unionAll(more).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return sums


def alignment(docs: DataFrame, paths: tuple[str, str] | None = None, most_head: int = MOST_HEAD) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count in the corpus is the highest of their
    id of B, ties included), count_sum (over links) and groups_sha256."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = store(rows.mapInArrow(_aligned(paths or vocabularies()), ALIGNED), "aligned")
    counts = store(pair_counts(aligned), "pair-counts")
    found = aligned.drop("pairs").join(link_sums(aligned, counts, most_head), "row", "left")
    return found.select("doc_id", *_COUNTS, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
