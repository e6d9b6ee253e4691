"""Byte-pair encoding with word ends by an index of pair occurrences, and its decoding.

The words of a chunk of a partition that were not seen before are laid out as one array of symbols with links to their
neighbours. An index maps each mergeable pair, by its rank, to all its positions in the chunk. Ranks are applied in
ascending order, all positions of a rank at once; each merge takes its two symbols off the lists they were on and puts
the pairs with its new neighbours on theirs. A position that an earlier merge changed is skipped when its rank comes. A
merge whose symbol is part of a pair of lower rank (the vocabulary has such) is applied to the first occurrence of each
word only before the lower ranks are looked at again; so every word is merged as if it were alone, lowest rank first,
from left to right.

Texts are cut at ASCII spaces, tabs and line ends, where no word goes on. Lower-casing, NFC and the cut into words are the
vocabulary's own; strings of its added tokens are those tokens. Ids are the tokenizers library's with
``add_special_tokens=False``, texts those of its ``decode(ids, skip_special_tokens=False)``: tokens joined by spaces.

Null and empty texts have no tokens and the empty text. Rows that repeat a doc_id, and null ids, all stay. An empty table
gives no rows. Other columns are left out. A text is worked on as a whole, so a task needs about 30 times the bytes of
its longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegate.llm.shared import CHUNK_BYTES, chunks
from tidegate.llm.tokens import _byte_letters, _gather

#: Parts between white space, and words, that a Python worker remembers; above it the memory is emptied.
CACHE_PARTS = 400_000
#: Tokens whose texts are put together at once.
JOINED = 1 << 18

# The vocabulary's cut into words, for texts below U+0250; its \s there is [\t-\r \x85\xa0].
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+")
# Upper case that becomes two characters.
_DOTTED_I = "İ"


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


class PairIndex:
    """Merges symbols of many words by ascending ranks of the vocabulary's pairs."""

    def __init__(self, vocab: dict[str, int], merges: list, word_end: str):
        self.base = max(vocab.values()) + 1
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in merges)]
        keys = np.array([a * self.base + b for a, b, _ in pairs], np.int64)
        self.rank_of_key = np.argsort(keys)
        self.keys = keys[self.rank_of_key]
        self.left, self.right, self.new = (np.array(c, np.int64) for c in zip(*pairs))
        # Lowest rank that a symbol is part of; a merge is early if that of its new symbol is below its own rank.
        first = np.full(self.base, len(pairs))
        np.minimum.at(first, self.left, np.arange(len(pairs)))
        np.minimum.at(first, self.right, np.arange(len(pairs)))
        self.early = first[self.new] < np.arange(len(pairs))
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[b]] for b in range(256)])
        self.last = np.array([vocab[letters[b] + word_end] for b in range(256)])

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; -1 where they do not merge."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], -1)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words one after another, and how many each word has; words are not empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(words), np.uint8)
        n = len(data)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends - lengths] = -1

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray, rank: np.ndarray) -> None:
            """Put positions on the lists of their ranks."""
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, held in zip(rank[np.concatenate([[0], cuts])].tolist() if len(rank) else (), np.split(at, cuts)):
                if r in index:
                    index[r].append(held)
                else:
                    index[r] = [held]
                    heapq.heappush(active, r)

        at = np.flatnonzero(after >= 0)
        rank = self.ranks(symbol[at], symbol[at + 1])
        add(at[rank >= 0], rank[rank >= 0])
        while active:
            r = heapq.heappop(active)
            held = index.pop(r)
            at = np.unique(np.concatenate(held)) if len(held) > 1 else held[0]
            a, b = self.left[r], self.right[r]
            # A symbol that was merged into its left neighbour is -1.
            at = at[symbol[at] == a]
            at = at[after[at] >= 0]
            at = at[symbol[after[at]] == b]
            if not len(at):
                continue
            if self.early[r]:
                first = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
                if not first.all():
                    add(at[~first], np.full(len(at) - int(first.sum()), r))
                at = at[first]
            elif a == b and len(at) > 1:
                at = self._apart(at, after)
            gone = after[at]
            symbol[at], symbol[gone] = self.new[r], -1
            after[at] = after[gone]
            onward = at[after[at] >= 0]
            before[after[onward]] = onward
            lefts = before[at]
            found = np.concatenate([lefts[lefts >= 0], onward])
            if len(found):
                rank = self.ranks(symbol[found], symbol[after[found]])
                add(found[rank >= 0], rank[rank >= 0])
        kept = symbol >= 0
        return symbol[kept], np.bincount(word[kept], minlength=len(words))

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of positions of a pair of equal symbols, every second one of each run that follow one another."""
        joined = np.concatenate([[False], after[at[:-1]] == at[1:]])
        start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
        return at[(np.arange(len(at)) - start) % 2 == 0]


class Coder:
    """Encodes Arrow columns of texts and joins tokens; one per Python worker."""

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.settings = json.load(f)
        model = self.settings["model"]
        self.pairs = PairIndex(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in self.settings["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        self.byte_of = {c: b for b, c in _byte_letters().items()}
        size = self.tokenizer.get_vocab_size()
        self.texts = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.decimals = [str(i) for i in range(size)]
        self.cache_parts = cache_parts
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes | int, int] = {}  # word, or id of an added token, to its number
        self.word_ids = np.zeros(0, np.int32)
        self.word_ends = np.zeros(1, np.int64)
        self.parts: dict[str, int] = {}
        self.part_ids = np.zeros(0, np.int32)
        self.part_ends = np.zeros(1, np.int64)

    def _words_of(self, part: str) -> list[bytes | int]:
        """Words of a part as UTF-8, added tokens as their ids."""
        if "<|" in part and self.specials.search(part):
            pieces = self.specials.split(part)
            return [w for p in pieces for w in ([self.added[p]] if p in self.added else self._words_of(p))]
        if not part:
            return []
        if max(part) < "ɐ" and _DOTTED_I not in part:
            low = part.lower()
            return [low.encode()] if low.isalpha() else [w.encode() for w in _WORDS.findall(low)]
        normal = self.tokenizer.normalizer.normalize_str(part)
        return [bytes(map(self.byte_of.__getitem__, w)) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _learn(self, parts: list[str]) -> None:
        """Ids of new parts, by one index over their new words."""
        if len(self.parts) + len(parts) > self.cache_parts and self.parts:
            raise RuntimeError("the memory is emptied between chunks only")
        cut = [self._words_of(p) for p in parts]
        new = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in self.words]
        plain = [w for w in new if isinstance(w, bytes)]
        ids, lengths = self.pairs.merge(plain) if plain else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        special = [w for w in new if not isinstance(w, bytes)]
        self.word_ids = np.concatenate([self.word_ids, ids, special]).astype(np.int32)
        self.words.update(zip([*plain, *special], range(len(self.words), len(self.words) + len(new))))
        self.word_ends = np.append(self.word_ends, self.word_ends[-1] + np.cumsum(np.append(lengths, np.ones(len(special), np.int64))))

        at = np.fromiter(map(self.words.__getitem__, chain.from_iterable(cut)), np.int64)
        lengths = self.word_ends[at + 1] - self.word_ends[at]
        self.part_ids = np.append(self.part_ids, _gather(self.word_ids, self.word_ends[at], lengths))
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(list(map(len, cut)))]
        self.part_ends = np.append(self.part_ends, self.part_ends[-1] + ends)
        self.parts.update(zip(parts, range(len(self.parts), len(self.parts) + len(parts))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (one more entry than texts); null is empty."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        spaced = pc.replace_substring_regex(texts.cast(pa.large_string()).fill_null(""), r"[ \t\r\n]+", " ")
        lists = pc.split_pattern(spaced, " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        distinct = coded.dictionary.to_pylist()
        new = [p for p in distinct if p not in self.parts]
        if len(self.parts) + len(new) > self.cache_parts:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        at = np.fromiter(map(self.parts.__getitem__, distinct), np.int64, len(distinct))
        at = at[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.part_ends[at + 1] - self.part_ends[at]
        return _gather(self.part_ids, self.part_ends[at], lengths), np.concatenate([[0], np.cumsum(lengths)])[offsets]

    def decode(self, ids: np.ndarray) -> str:
        texts = self.texts
        return " ".join([texts[i] for i in ids.tolist()])

    def digest(self, ids: np.ndarray, texts: list[str]) -> str:
        """SHA-256 of the ids' texts joined by spaces, without holding the whole of a long one."""
        got = hashlib.sha256()
        for start in range(0, len(ids), JOINED):
            if start:
                got.update(b" ")
            got.update(" ".join([texts[i] for i in ids[start : start + JOINED].tolist()]).encode())
        return got.hexdigest()


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for a vocabulary file."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids) of ``docs(doc_id, text)``."""
    path = tokenizer or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=2 * CHUNK_BYTES):
            ids, begins = coder(path).encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids))
            yield pa.record_batch([batch.column("doc_id"), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) of ``tokens(doc_id, ids)``; null ids are an empty text."""
    path = tokenizer or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [coder(path).decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the decimal ids joined by spaces and of the decoded text."""
    path = tokenizer or vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=2 * CHUNK_BYTES):
            own = coder(path)
            ids, begins = own.encode(batch.column("text"))
            cut = [ids[a:b] for a, b in zip(begins, begins[1:])]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.diff(begins), pa.int64()), pa.array([own.digest(x, own.decimals) for x in cut], pa.string()), pa.array([own.digest(x, own.texts) for x in cut], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
