"""Ties across parts, and long unbroken words, against the whole-text search."""

import random
import subprocess
import sys
import zlib

import pyarrow as pa
import pytest

from tidegate.llm import piece_lattice
from tidegate.llm.piece_lattice import Segmenter, default_model


@pytest.fixture(scope="module")
def own():
    return Segmenter(default_model())


def test_parts_keep_the_rule_for_ties(own):
    rng = random.Random(9)
    words = ["the", "many", "words", "wordy", "ab", "漢字", "a", "tion", "Größe", "\U0001F600", "xx", "the,"]
    texts = [" ".join(rng.choices(rng.sample(words, 3), k=rng.randint(1, 12))) for _ in range(300)]
    for text, best in zip(texts, own.segment(pa.array(texts))):
        expected = own.vocabulary.n_best(" " + text, own.n) if len(text) < piece_lattice.LONG_PART else own.vocabulary.n_best_long(" " + text, own.n)
        assert [(round(s * piece_lattice._UNIT), tuple(ids.tolist())) for s, ids, _ in best] == expected, text
        assert all(raw.removeprefix(b" ") == text.encode() for _, _, raw in best)


def test_links_find_what_tuples_find(own):
    rng = random.Random(10)
    for letters in ("a", "ab", "the", "etaoin", "a漢é\U0001F600"):
        for _ in range(60):
            part = "".join(rng.choices(letters, k=rng.randint(1, 40)))
            assert own.vocabulary.n_best_long(part, 4) == own.vocabulary.n_best(part, 4), part


def test_a_long_word_takes_memory_by_its_length():
    code = """
import random, resource, zlib
import pyarrow as pa
from tidegate.llm.piece_lattice import Segmenter, default_model
own = Segmenter(default_model())
for text in ("".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "a" * 64_000):
    best = next(own.segment(pa.array([text])))
    assert len(best) == 3 and all(raw == b" " + text.encode() for _, _, raw in best)
    assert best[0][0] >= best[1][0] >= best[2][0] and len({ids.tobytes() for _, ids, _ in best}) == 3
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, env={"PYTHONPATH": ":".join(p for p in sys.path if p), "PATH": ""})
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1_000_000  # KB


def test_digests_of_rows(spark):
    texts = [None, "", " two  spaces ", "漢字 ▁ \U0001F600", "the the the the", "x" * 3000]
    docs = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in piece_lattice.segmentations(docs, with_ids=False, with_decoded=True).collect():
        assert r["exact"] and r["decoded_crc32"] == zlib.crc32((texts[r["doc_id"] or 0] or "").encode())
