"""The best N segmentations of texts into the pieces of a SentencePiece vocabulary, and back to the text.

The lattice of a text has an edge for each piece that stands somewhere in it, and the bytes of each character that has
no piece. A forward Viterbi pass gives the best score from the start to every position; a search from the end towards
the start, ordered by the score so far plus that exact rest (A*), then yields segmentations best first.

Two neighbouring characters whose bytes stand next to each other in no piece are never joined, so a text is cut there and its
parts are searched on their own: each distinct part once for its best and second-best (a bounded memory holds them). The
N best of the text differ from the best in few parts: the N - 1 whose second-best costs least (of equal ones those that
the rule for ties puts first) are enough, and only these are searched for N. The search over a long part keeps its
ways as links to the ways they go on from, so memory grows with the part's length.

Scores are natural logarithms of piece probabilities. A vocabulary that holds ranks instead of probabilities (whole
numbers, as BPE models do) gets probabilities proportional to 1 / (rank + 1), bytes ranking last. Sums are kept in
millionths, so ties are true ties; they go to the segmentation whose ids, read from the end, come first.

As the vocabulary's own normalization does, a space is put before a text that is not empty; nothing else changes, so
decoding gives back the exact text. Null and empty texts have one segmentation, without pieces, score 0. Texts with
fewer than N segmentations return those they have. Repeated rows each get theirs, an empty table gives none, other
columns are left out.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tidegate.llm.shared import as_bytes, chunks, crc
from tidegate.llm.tokens import _gather

N_BEST = 3
#: Distinct parts that a Python worker remembers; above it the memory is emptied.
CACHE_PARTS = 600_000
#: Characters from which on the search keeps links; both ways give the same.
LONG_PART = 200
_MARK = "▁"
_UNIT = 1_000_000

Segmentation = tuple[int, tuple[int, ...]]


class _Link:
    """An id and the link to the id after it in the text; ``jump`` leads to a link further on, for quick comparison."""

    __slots__ = ("depth", "id", "jump", "onward")

    def __init__(self, onward: _Link | None, piece: int):
        self.onward, self.id = onward, piece
        self.depth = onward.depth + 1 if onward else 1
        far = onward.jump if onward else None
        even = onward and far and far.jump and onward.depth - far.depth == far.depth - far.jump.depth
        self.jump = far.jump if even else onward


def _comes_first(a: _Link | None, b: _Link | None) -> bool:
    """Whether the ids of ``a``, read from the end of the text, come before those of ``b``."""
    depth_a, depth_b = a.depth if a else 0, b.depth if b else 0
    depth = min(depth_a, depth_b)
    if not depth:
        return depth_a < depth_b
    while a.depth > depth:
        a = a.jump if a.jump.depth >= depth else a.onward
    while b.depth > depth:
        b = b.jump if b.jump.depth >= depth else b.onward
    if a is b:
        return depth_a < depth_b
    # Links at one depth have their jumps at one depth.
    while a.onward is not b.onward:
        a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.onward, b.onward)
    return a.id < b.id if a.id != b.id else depth_a < depth_b


class _Way:
    """A way from the end of a part back to ``at``."""

    __slots__ = ("at", "cost", "done", "tail")

    def __init__(self, cost: int, tail: _Link | None, at: int, done: int):
        self.cost, self.tail, self.at, self.done = cost, tail, at, done

    def __lt__(self, other: _Way) -> bool:
        return self.cost < other.cost if self.cost != other.cost else _comes_first(self.tail, other.tail)

    def ids(self) -> tuple[int, ...]:
        found, link = [], self.tail
        while link:
            found.append(link.id)
            link = link.onward
        return tuple(found)


class Vocabulary:
    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        own = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        scores = {i: model.get_score(i) for i in own}
        if all(s == int(s) for s in scores.values()):
            order = sorted(own, key=lambda i: (-scores[i], i))
            total = np.log((1.0 / np.arange(1, len(order) + 2)).sum())
            scores = {i: -float(np.log(r + 1) + total) for r, i in enumerate(order)}
            byte = -float(np.log(len(order) + 1) + total)
        else:
            byte = min(scores.values()) - 10.0
        self.byte_score = round(byte * _UNIT)
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.unknown = model.unk_id()
        self.texts = {i: model.id_to_piece(i).replace(_MARK, " ") for i in own}
        self.pieces = {t: (i, round(scores[i] * _UNIT)) for i, t in self.texts.items()}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.raw = {i: t.encode() for i, t in self.texts.items()} | {i: bytes([b]) for i, b in self.bytes.items()}
        self.longest = max(map(len, self.pieces))
        self.lengths = np.array([len(self.raw.get(i, b"")) for i in range(n)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.raw.get(i, b"") for i in range(n)), np.uint8)
        # Every beginning of a piece; None where it is none itself, so that a search can stop where no piece goes on.
        self.begun: dict[str, tuple[int, int] | None] = {t[:k]: None for t in self.pieces for k in range(1, len(t))} | self.pieces
        # joined[x, y]: some piece has byte y after byte x, or y goes on with a character.
        self.joined = np.zeros((256, 256), bool)
        self.joined[:, 0x80:0xC0] = True
        for t in self.pieces:
            raw = np.frombuffer(t.encode(), np.uint8)
            self.joined[raw[:-1], raw[1:]] = True

    def n_best(self, part: str, n: int) -> list[Segmentation]:
        """(score, ids) of the best ``n`` segmentations of a part."""
        if len(part) > LONG_PART:
            return self.n_best_long(part, n)
        size, begun = len(part), self.begun
        least = -(1 << 62)
        best = [0] + [least] * size
        into: list[list[tuple[int, int, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
        for start in range(size):
            here = best[start]
            if here == least:
                continue
            alone = False
            for end in range(start + 1, size + 1):
                found = begun.get(part[start:end], False)
                if found:
                    alone = alone or end == start + 1
                    piece, score = found
                    into[end].append((start, score, (piece,)))
                    if here + score > best[end]:
                        best[end] = here + score
                elif found is False:
                    break
            if not alone:
                raw = part[start].encode()
                ids = tuple(self.byte_ids.get(b, self.unknown) for b in raw)
                into[start + 1].append((start, self.byte_score * len(raw), ids))
                best[start + 1] = max(best[start + 1], here + self.byte_score * len(raw))
        heap = [(-best[size], (), size, 0)]
        out: list[Segmentation] = []
        while heap and len(out) < n:
            cost, tail, at, done = heapq.heappop(heap)
            if at == 0:
                out.append((done, tail[::-1]))
                continue
            for start, score, ids in into[at]:
                heapq.heappush(heap, (-(best[start] + score + done), tail + ids[::-1], start, done + score))
        return out

    def n_best_long(self, part: str, n: int) -> list[Segmentation]:
        """The same with links in place of tuples, and with edges that are looked up again when they are needed."""
        size, begun = len(part), self.begun
        least = -(1 << 62)
        best = np.full(size + 1, least, np.int64)
        best[0] = 0
        for start in range(size):
            here = int(best[start])
            if here == least:
                continue
            alone = False
            for end in range(start + 1, size + 1):
                found = begun.get(part[start:end], False)
                if found:
                    alone = alone or end == start + 1
                    best[end] = max(best[end], here + found[1])
                elif found is False:
                    break
            if not alone:
                best[start + 1] = max(best[start + 1], here + self.byte_score * len(part[start].encode()))
        heap = [_Way(-int(best[size]), None, size, 0)]
        out: list[Segmentation] = []
        while heap and len(out) < n:
            way = heapq.heappop(heap)
            at = way.at
            if at == 0:
                out.append((way.done, way.ids()))
                continue
            for start in range(max(0, at - self.longest), at):
                here = int(best[start])
                found = self.pieces.get(part[start:at])
                if here == least:
                    continue
                if found:
                    done = way.done + found[1]
                    heapq.heappush(heap, _Way(-(here + done), _Link(way.tail, found[0]), start, done))
                elif start == at - 1:
                    raw, tail = part[start].encode(), way.tail
                    for b in reversed(raw):
                        tail = _Link(tail, self.byte_ids.get(b, self.unknown))
                    done = way.done + self.byte_score * len(raw)
                    heapq.heappush(heap, _Way(-(here + done), tail, start, done))
        return out

    def spell(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces."""
        return _gather(self.flat, self.starts[ids], self.lengths[ids]).tobytes()

    def decode(self, ids: list[int]) -> str:
        """The text of a segmentation."""
        raw = b"".join([self.raw.get(i, b"") for i in ids])
        return raw.decode("utf-8", "replace").removeprefix(" ")


class Segmenter:
    """Segments Arrow columns of texts; one per Python worker."""

    def __init__(self, path: str, n: int = N_BEST, cache_parts: int = CACHE_PARTS):
        self.vocabulary = Vocabulary(path)
        self.n, self.cache_parts = n, cache_parts
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.arrays: list[np.ndarray] = []
        self.costs: list[int] = []  # of the second-best, or more than any
        self.behind: list[bool] = []  # whether the second-best's ids, read from the end, come after those of the best
        self.scores: list[int] = []
        self.deep: dict[int, list[Segmentation]] = {}  # the N best of parts that were looked into

    def _learn(self, part: str) -> int:
        got = self.vocabulary.n_best(part, 2)
        k = self.number[part] = len(self.arrays)
        self.arrays.append(np.array(got[0][1], np.int32))
        self.costs.append(got[0][0] - got[1][0] if len(got) > 1 else 1 << 60)
        self.behind.append(len(got) < 2 or got[1][1][::-1] > got[0][1][::-1])
        self.scores.append(got[0][0])
        return k

    def _deep(self, k: int, part: str) -> list[Segmentation]:
        found = self.deep.get(k)
        if found is None:
            found = self.vocabulary.n_best(part, self.n)
            if len(part) <= LONG_PART:
                self.deep[k] = found
        return found

    def segment(self, texts: pa.Array) -> Iterator[list[tuple[float, np.ndarray, bytes]]]:
        """For each whole text, (score, ids, bytes that the ids spell) of its best segmentations, best first."""
        if len(self.number) > self.cache_parts:
            self._forget()
        raw = [b" " + t if t else b"" for t in as_bytes(texts)]
        data = b"".join(raw)
        chars = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(t) for t in raw], dtype=np.int64)
        if not len(chars):
            yield from ([(0.0, np.zeros(0, np.int32), b"")] for _ in raw)
            return
        cut = np.append(True, ~self.vocabulary.joined[chars[:-1], chars[1:]])
        cut[ends[ends < len(chars)]] = True
        edges = np.append(np.flatnonzero(cut), len(chars))
        coded = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
        distinct, number = coded.dictionary.to_pylist(), self.number
        own = np.array([number[p] if p in number else self._learn(p) for p in distinct], np.int64)
        code = coded.indices.to_numpy(zero_copy_only=False)
        score_of = np.array([self.scores[k] for k in own], np.int64)
        cost_of = np.array([self.costs[k] for k in own], np.int64)
        behind_of = np.array([self.behind[k] for k in own], bool)
        ids_of = [self.arrays[k] for k in own]
        sizes = np.array([len(x) for x in ids_of], np.int64)
        flat, starts = np.concatenate(ids_of), np.cumsum(sizes) - sizes
        lengths = sizes[code]
        behind = np.cumsum(lengths)
        at = np.arange(behind[-1])
        at += np.repeat(starts[code] - behind + lengths, lengths)
        ids = flat[at]
        before = behind - lengths
        # The bytes of all pieces, and where each piece's begin: all segmentations share those of unchanged parts.
        spelled = memoryview(self.vocabulary.spell(ids))
        byte_at = np.concatenate([[0], np.cumsum(self.vocabulary.lengths[ids])])
        first = np.searchsorted(edges, np.append(0, ends))  # parts of each text
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if a == b:
                yield [(0.0, np.zeros(0, np.int32), b"")]
                continue
            found = {a + p: self._deep(int(own[code[a + p]]), distinct[code[a + p]]) for p in self._cheapest(cost_of[code[a:b]], behind_of[code[a:b]])}
            # Of equal costs those come first whose ids, read from the end, do: the last part where two differ decides.
            ways: list[tuple[int, tuple[int, ...], dict[int, int]]] = [(0, (), {})]
            for p, best in found.items():
                order = sorted(range(len(best)), key=lambda k: best[k][1][::-1])
                place = {k: i for i, k in enumerate(order)}
                tried = [(c + best[0][0] - s, (place[k], *t), {**w, p: k} if k else w) for c, t, w in ways for k, (s, _) in enumerate(best)]
                ways = heapq.nsmallest(self.n, tried, key=lambda x: x[:2])
            score, low, high = int(score_of[code[a:b]].sum()), int(before[a]), int(behind[b - 1])
            out = []
            for cost, _, way in ways:
                pieces, spelling, done = [], [], low
                for p, k in way.items():  # in the order of the text
                    other = np.array(found[p][k][1], np.int32)
                    pieces += [ids[done : before[p]], other]
                    spelling += [spelled[byte_at[done] : byte_at[before[p]]], self.vocabulary.spell(other)]
                    done = int(behind[p])
                pieces.append(ids[done:high])
                spelling.append(spelled[byte_at[done] : byte_at[high]])
                out.append(((score - cost) / _UNIT, np.concatenate(pieces), b"".join(spelling)))
            yield out

    def _cheapest(self, costs: np.ndarray, behind: np.ndarray) -> list[int]:
        """The N - 1 parts whose second-best is first, in the order of the text.

        Of equal costs those come first whose second-best comes before the best, nearest to the end first, then the
        others, farthest from the end first: read from the end, that is the order of the texts' ids.
        """
        few = min(self.n - 1, len(costs))
        if few == 0:
            return []
        near = np.flatnonzero(costs <= np.partition(costs, few - 1)[few - 1])
        order = np.lexsort((np.where(behind[near], near, -near), behind[near], costs[near]))
        return sorted(near[order[:few]].tolist())


_SEGMENTERS: dict[tuple[str, int], Segmenter] = {}


def segmenter(path: str, n: int) -> Segmenter:
    """The worker's segmenter."""
    if (path, n) not in _SEGMENTERS:
        _SEGMENTERS[path, n] = Segmenter(path, n)
    return _SEGMENTERS[path, n]


def default_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def segmentations(docs: DataFrame, n: int = N_BEST, model: str | None = None, with_ids: bool = True, with_decoded: bool = False) -> DataFrame:
    """Per document and segmentation: doc_id, rank from 1, score, n_tokens, ids_crc32, and the ids if wanted.

    ``with_decoded`` adds decoded_crc32, the crc32 of the text (UTF-8) that the ids decode to, and exact: whether that is
    the document's text (an empty one for null).
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(path, n)
        for batch in chunks(batches):
            rows = []
            texts = as_bytes(batch.column("text")) if with_decoded else [None] * batch.num_rows
            for doc, text, best in zip(batch.column("doc_id").to_pylist(), texts, own.segment(batch.column("text"))):
                for rank, (score, ids, raw) in enumerate(best, 1):
                    back = raw.removeprefix(b" ") if with_decoded else b""
                    if with_decoded and back != text and text:  # pieces that spell no text are replaced
                        back = own.vocabulary.decode(ids.tolist()).encode()
                    rows.append((doc, rank, score, len(ids), crc(ids), ids if with_ids else None, zlib.crc32(back), back == (text or b"")))
            columns = list(zip(*rows)) or [()] * 8
            kinds = (pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["doc_id", "rank", "score", "n_tokens", "ids_crc32"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in columns[5]])]).astype(np.int32)
                flat = np.concatenate(columns[5]) if rows else np.zeros(0, np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
                names.append("ids")
            if with_decoded:
                arrays += [pa.array(columns[6], pa.int64()), pa.array(columns[7], pa.bool_())]
                names += ["decoded_crc32", "exact"]
            yield pa.record_batch(arrays, names=names)

    schema = "doc_id long, rank int, score double, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    schema += ", decoded_crc32 long, exact boolean" if with_decoded else ""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to rows (doc_id, rank, ids)."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = segmenter(path, N_BEST).vocabulary
        for batch in batches:
            texts = [vocabulary.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("rank"), pa.array(texts, pa.string())], names=["doc_id", "rank", "decoded"])

    return rows.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, decoded string")
