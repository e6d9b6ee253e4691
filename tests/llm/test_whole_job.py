"""Cases in which operators once did less than the whole job."""

import base64
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidegate.llm import compression_bands, piece_lattice, queries, suffix_tree


def test_states_follow_an_absolute_count_and_scores_follow_the_tree(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(60)] + ["qzx"] * 60
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    # "q" makes up 5e-4 of the positions, but occurs often enough.
    settings = suffix_tree.Settings(depth=3, least_count=50, head_share=1e-3)
    counts = suffix_tree.context_counts(table, 3)
    tree = suffix_tree.grow(counts, settings)
    assert ord("q") in tree.contexts[0]
    training = F.col("doc_id") % 5 > 0
    tree = suffix_tree.grow(suffix_tree.context_counts(table.where(training), 3), settings)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(table, training, settings).collect()}
    for i, t in enumerate(texts):
        codes, _ = suffix_tree.codes_of([t.encode()], 3)
        assert got[i] == pytest.approx(tree.log10(codes).sum())


def test_contexts_of_seven_bytes(spark):
    texts = ["abcdefg1", "xbcdefg2", "漢字漢字漢"] * 80
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    settings = suffix_tree.Settings(depth=7)
    tree = suffix_tree.grow(suffix_tree.context_counts(table, 7), settings)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(table, F.lit(True), settings).collect()}
    for i in range(3):
        codes, _ = suffix_tree.codes_of([texts[i].encode()], 7)
        assert got[i] == pytest.approx(tree.log10(codes).sum())
    assert len(tree.contexts[6]) and np.all(tree.onward[6] > 0)


def test_op7_decodes_every_document_and_rank(spark, tmp_path):
    texts = [None, "", " two  spaces ", "some words\nand lines", "漢字 \u2581 \U0001F600", "many words come here " * 3000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_sentencepiece(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == set(range(len(texts))) and max(r["rank"] for r in got) == piece_lattice.N_BEST
    for r in got:
        assert r["exact"] and r["decoded_crc32"] == zlib.crc32((texts[r["doc_id"]] or "").encode())


def test_compression_bands_judge_the_rest_of_a_text():
    rng, bands, packer = random.Random(3), compression_bands.Bands(), zstandard.ZstdCompressor(level=3)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(9000)).encode()
    noise, again = base64.b64encode(rng.randbytes(9000)), b"one sentence that comes again and again. " * 300

    def verdict(text):
        return compression_bands.compression(text, packer, bands)[4]

    for size in (2100, 4096, 5000, 6996, 8191, 8192, 11000, 40000):
        assert verdict(prose[:size]) == "ok", size
    assert verdict(prose[:4096] + noise[:2900]) == "incompressible_chunks"
    assert verdict(prose[:4096] + again[:2900]) == "repetitive_chunks"
    assert verdict(prose[:8192] + noise[:4000]) == "incompressible_chunks"  # below a whole chunk
