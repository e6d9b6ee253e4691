"""Hashed byte n-grams of whole texts: mean counts for training, and linear functions of them for prediction.

A text's vector has, for each bucket, the share of its n-grams (of all orders together) that fall there. A linear
function of the vector is the mean of the n-grams' weights, which is computed for many texts at once without building
vectors. An empty text has the zero vector.
"""

from __future__ import annotations

import numpy as np

_ODD = np.array([0x9E3779B97F4A7C15 + 2 * k * 0x1234567 for k in range(9)], np.uint64)


def _grams(data: np.ndarray, ends: np.ndarray, orders: tuple[int, ...], bits: int):
    """For each order: buckets by position, and the positions whose n-gram would cross a text's end."""
    for order in orders:
        n = len(data) - order + 1
        if n <= 0:
            continue
        code = data[:n].astype(np.uint64)
        for k in range(1, order):
            code = (code << np.uint64(8)) | data[k : n + k]
        bucket = ((code * _ODD[order]) >> np.uint64(64 - bits)).astype(np.intp)
        across = np.concatenate([ends - k for k in range(1, order)]) if order > 1 else np.zeros(0, np.int64)
        yield order, bucket, across[(across >= 0) & (across < n)]


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each text ends."""
    ends = np.cumsum([len(t) if t else 0 for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(t for t in texts if t), np.uint8), ends


def totals(lengths: np.ndarray, orders: tuple[int, ...]) -> np.ndarray:
    """Number of n-grams of each text."""
    return sum(np.maximum(lengths - n + 1, 0) for n in orders)


def scores(texts: list[bytes | None], weights: np.ndarray, orders: tuple[int, ...]) -> np.ndarray:
    """``weights`` (functions x 2^bits) applied to each text's vector: texts x functions."""
    data, ends = joined(texts)
    lengths = np.diff(ends, prepend=0)
    out = np.zeros((len(texts), len(weights)))
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    starts = ends[some] - lengths[some]
    bits = int(weights.shape[1]).bit_length() - 1
    for _, bucket, across in _grams(data, ends, orders, bits):
        inside = starts < len(bucket)
        for j, w in enumerate(weights):
            got = w[bucket]
            got[across] = 0.0
            out[some[inside], j] += np.add.reduceat(got, starts[inside])
    return out / np.maximum(totals(lengths, orders), 1)[:, None]


def vectors(texts: list[bytes | None], bits: int, orders: tuple[int, ...]) -> np.ndarray:
    """Each text's vector: texts x 2^bits."""
    out = np.zeros((len(texts), 1 << bits), np.float32)
    for i, text in enumerate(texts):
        data, ends = joined([text])
        for _, bucket, _ in _grams(data, ends, orders, bits):
            out[i] += np.bincount(bucket, minlength=1 << bits)
        out[i] /= max(totals(ends, orders)[0], 1)
    return out
