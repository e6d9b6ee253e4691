"""Byte-level BPE ids of whole texts, by the tokenizers library.

The vocabulary's pattern never joins a character with white space after it. So a text is cut before each single space
and each run of line feeds, and the parts' ids, kept in a bounded memory, are put together. A part that is one run of
letters goes straight to the library's BPE model, all others through its whole chain. Texts with other white space, or
with spaces in a row, are encoded in one piece, and so are texts that hold a string of an added token where those are
tokens (the library's default). All ways give the ids of the whole text (tested against it).
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Parts that a Python worker remembers; above it the memory is emptied.
CACHE_PARTS = 500_000
END = 0

# White space besides the plain space and the line feed, or a space in a row with either.
_ODD = r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|  | \n|\n "
_MARKS = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
# Marks a part that has no space before it; texts that hold it are not cut.
_BARE = "\r"


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level BPE: visible Latin-1 stands for itself, the rest follows from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Encodes Arrow columns of texts; one per Python worker. Without ``specials``, added tokens' strings are plain text."""

    def __init__(self, path: str, cache_parts: int = CACHE_PARTS, specials: bool = True):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if specials else []
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.cache_parts = cache_parts
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, key: str) -> list[int]:
        text = key if key[:1] == "\n" else key[1:] if key[:1] == _BARE else " " + key
        bare = text[1:] if text[:1] == " " else text
        if bare.isascii() and bare.isalpha():
            return [x.id for x in self.model.tokenize(self.letters[32] + bare if len(bare) < len(text) else bare)]
        if bare.isalpha() and max(bare) < "ɐ":
            return [x.id for x in self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]
        return self._whole([text])[0]

    def _learn(self, keys: list[str]) -> None:
        got = list(map(self._ids, keys))
        lengths = np.fromiter(map(len, got), np.int64, len(got))
        total, n = int(lengths.sum()), len(self.known)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(got) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(got), np.int32, total)
        self.starts[n : n + len(got)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n : n + len(got)] = lengths
        self.used += total
        self.known.update(zip(keys, range(n, n + len(got))))

    def _places(self, keys: list[str]) -> np.ndarray:
        known = self.known
        missing = [k for k in dict.fromkeys(keys) if k not in known]
        if missing:
            self._learn(missing)
        return np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts one after another, where each part's begin, and how many it has.

        Marks at the end of a part that follow a letter have ids of their own, so ``word,`` costs no more than ``word``.
        """
        stems = pc.ascii_rtrim(parts, characters=_MARKS)
        marked = pc.and_(pc.not_equal(pc.binary_length(stems), pc.binary_length(parts)), pc.match_substring_regex(stems, r"\p{L}\z"))
        stems = pc.if_else(marked, stems, parts)
        coded = stems.dictionary_encode()
        stem_at = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        with_tail = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        cut = pc.binary_length(stems).to_numpy(zero_copy_only=False)[with_tail]
        texts = parts.take(pa.array(with_tail)).cast(pa.large_binary()).to_pylist()
        tails = [_BARE + t[c:].decode() for t, c in zip(texts, cut)]
        # Entry 0 of each pair is the stem's, entry 1 the marks', both as places in ``flat``.
        at = np.zeros(2 * len(parts), np.int64)
        at[::2] = stem_at
        at[2 * with_tail + 1] = self._places(tails)
        lengths = self.lengths[at]
        bare = np.ones(len(parts), bool)
        bare[with_tail] = False
        lengths[1::2][bare] = 0
        flat = _gather(self.flat, self.starts[at], lengths)
        own = lengths[::2] + lengths[1::2]
        return flat, np.cumsum(own) - own, own

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (one more entry than texts); null is empty."""
        if len(self.known) > self.cache_parts:
            self._forget()
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).astype(bool)
        for added in self.added:
            odd |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False).astype(bool)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts) if odd.any() else texts
        plain = pc.replace_substring(plain, "\n", " \n")
        while pc.any(pc.match_substring(plain, "\n \n")).as_py():  # a run of line feeds stays together
            plain = pc.replace_substring(plain, "\n \n", "\n\n")
        lists = pc.split_pattern(plain, " ")
        offsets = lists.offsets.to_numpy()
        parts = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        # The first part of a text has no space before it.
        coded = parts.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = pc.binary_join_element_wise(pa.scalar(_BARE, pa.large_string()), parts.take(pa.array(offsets[:-1])), pa.scalar("", pa.large_string())).dictionary_encode()
        code[offsets[:-1]] = len(coded.dictionary) + first.indices.to_numpy(zero_copy_only=False)
        flat, starts, lengths = self._parts(pa.concat_arrays([coded.dictionary, first.dictionary]))
        lengths = lengths[code]
        ids = _gather(flat, starts[code], lengths)
        begins = np.concatenate([[0], np.cumsum(lengths)])[offsets]
        if odd.any():
            cut = [ids[a:b] for a, b in zip(begins, begins[1:])]
            for i in np.flatnonzero(odd):
                cut[i] = np.array(self._whole([texts[i].as_py()])[0], np.int32)
            begins = np.concatenate([[0], np.cumsum([len(x) for x in cut])]).astype(np.int64)
            ids = np.concatenate(cut)
        return ids, begins


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of all rows one after another."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(starts - ends + lengths, lengths)
    return flat[at]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, specials: bool = True) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = Encoder(path, specials=specials)
    return _ENCODERS[path, specials]
