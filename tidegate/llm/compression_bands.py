"""Quality rules by compression bands: zstandard ratios of the whole text and of fixed chunks, with limits by length.

The ratio of a text is its bytes over its compressed bytes. A band gives, up to a length in bytes, the least and the
greatest ratio of ordinary text: below it the text is incompressible (random or encoded data), above it repetitive.
Chunks of a fixed number of bytes find stretches that the whole hides: the text is rejected when more than a share of
its chunks lies outside their band. The last chunk is as long as the others and ends where the text ends, so it may
overlap the one before and no rest goes unjudged. Texts below two chunks have smaller chunks with a band of their own;
those no longer than such a chunk are judged by the ratio of the whole, which covers the same bytes.

Null and empty texts have no words, so they fail the base rule. Results do not depend on other rows; repeated rows each
get theirs, an empty table gives none, and other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import as_bytes, chunks, words_of

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits by length: rows (longest text in bytes, least ratio, greatest ratio), the last without a length."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.80, 2.0),
        (512, 1.15, 2.6),
        (1024, 1.25, 3.2),
        (2048, 1.33, 4.0),
        (8192, 1.45, 5.5),
        (65536, 1.50, 7.5),
        (float("inf"), 1.50, 10.0),
    )
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (1.40, 5.0)
    small_chunk_bytes: int = 2048
    small_chunk: tuple[float, float] = (1.33, 4.0)
    bad_chunk_share: float = 0.25
    level: int = 3

    def limits(self, size: int) -> tuple[float, float]:
        return next((low, high) for longest, low, high in self.whole if size <= longest)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, whole_ratio double, n_chunks long, n_low_chunks long, n_high_chunks long, verdict string")


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that stand in a window of three that occurs twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    key = ids[:n]
    for k in range(1, window):
        if k > 1:  # keep the numbers small enough for the next product
            key = pd.factorize(key)[0]
        key = key * len(number) + ids[k : n + k]
    code, _ = pd.factorize(key)
    often = np.bincount(code)[code] > 1
    marked = np.zeros(len(words), bool)
    for k in range(window):
        marked[k : n + k] |= often
    return int(marked.sum())


def measures(text: bytes | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or b""
    words = words_of(text)
    joined = b"".join(words)
    chars = len(joined) - int(((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80).sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def compression(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, int, int, int, str]:
    """Ratio of the whole, number of chunks, of those below and above their band, and the verdict."""
    size = len(text)
    whole = size / len(packer.compress(text)) if size else 0.0
    step, (least, most) = bands.chunk_bytes, bands.chunk
    if size < 2 * step:
        step, (least, most) = bands.small_chunk_bytes, bands.small_chunk
    starts = [*range(0, size - step, step), size - step] if size > step else []
    ratios = [step / len(packer.compress(text[i : i + step])) for i in starts]
    low, high = sum(r < least for r in ratios), sum(r > most for r in ratios)
    floor, ceiling = bands.limits(size)
    if whole < floor:
        verdict = "incompressible"
    elif whole > ceiling:
        verdict = "repetitive"
    elif low > bands.bad_chunk_share * len(ratios):
        verdict = "incompressible_chunks"
    elif high > bands.bad_chunk_share * len(ratios):
        verdict = "repetitive_chunks"
    else:
        verdict = "ok"
    return whole, len(ratios), low, high, verdict


def compression_rules(docs: DataFrame, bands: Bands = Bands(), min_words: int = 50, repeat_percent: int = 50) -> DataFrame:
    """Per document: base measures, base_failed, kept, and what the bands saw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        kinds = pa.schema([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
                           ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("whole_ratio", pa.float64()),
                           ("n_chunks", pa.int64()), ("n_low_chunks", pa.int64()), ("n_high_chunks", pa.int64()), ("verdict", pa.string())])
        for batch in chunks(batches):
            rows = []
            for text in as_bytes(batch.column("text")):
                base = measures(text)
                failed = base[0] < min_words or 100 * base[4] > repeat_percent * base[0]
                seen = compression(text or b"", packer, bands)
                rows.append((*base, failed, not failed and seen[4] == "ok", *seen))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, kinds))], names=["doc_id", *kinds.names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
