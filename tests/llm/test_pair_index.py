"""Ids and texts of the pair index against the tokenizers library with its default settings."""

import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidegate.llm import pair_index

DOCS = "doc_id long, text string, ids string, n_tokens string, word string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(pair_index.vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def check(library, texts, **options):
    coder = pair_index.Coder(pair_index.vocabulary(), **options)
    ids, begins = coder.encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, begins, begins[1:]):
        expected = ids_of(library, t)
        assert ids[a:b].tolist() == expected, repr(t)
        assert coder.decode(ids[a:b]) == library.decode(expected, skip_special_tokens=False)


BITS = ["a", "B", "'s", "'", "''", "'LL", " ", "  ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", "　", "é", "é", "́", "漢", "1", "٣", "²", "½", "!", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>",
        "<|", "|>", "İ", "Σ", "ΑΣ", "ß", "ẞ", "ǅ", "ﬁ", "\U0001F600", "‍", "\x00", "don't", "hello", "ing", "the", "▁", "한", "각", "Å", "ª"]


def test_mixed_texts(library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 9))) for _ in range(20_000)]
    check(library, [None, "", " ", "\n", *texts], cache_parts=10**6)


def test_words_of_few_letters_that_repeat_pairs(library):
    rng = random.Random(4)
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 60))) for letters in ("a", "ab", "aab", "the", "haha", "xo", "!.", "lol", "ins", "etaoin", "éa") for _ in range(400)]
    check(library, texts)


def test_long_words(library):
    rng = random.Random(5)
    check(library, ["a" * 200_000, "".join(rng.choices("abcdeimnorst", k=200_000)), "ha" * 30_000, "!" * 5000, "1" * 3000])


def test_memory_is_emptied_between_chunks(library):
    coder = pair_index.Coder(pair_index.vocabulary(), cache_parts=20)
    rng = random.Random(6)
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abc", k=4)) for _ in range(9)) for _ in range(4)]
        ids, begins = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [ids_of(library, t) for t in texts]


def test_merges_that_make_a_lower_rank_possible():
    """abc has a rank below that of one of its merges: each word is merged as if it were alone."""
    vocab = {c: i for i, c in enumerate(pair_index._byte_letters().values())}
    vocab |= {c + "</w>": 256 + i for i, c in enumerate(list(vocab))}
    merges = [("b", "c"), ("x", "y"), ("abc", "a"), ("a", "bc"), ("abca", "b"), ("a", "a"), ("c", "b")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    vocab = {k: v for k, v in vocab.items()}
    vocab.setdefault("abc", len(vocab))
    index = pair_index.PairIndex(vocab, merges, "</w>")
    rank = {m: i for i, m in enumerate(merges)}
    rng = random.Random(8)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 14))) for _ in range(3000)]

    def alone(word):
        symbols = [*word[:-1], word[-1] + "</w>"]
        while True:
            ranked = [(rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
            if not ranked:
                return [vocab[s] for s in symbols]
            i = min(ranked)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    ids, lengths = index.merge([w.encode() for w in words])
    assert index.early.any()
    at = 0
    for w, n in zip(words, lengths.tolist()):
        assert ids[at : at + n].tolist() == alone(w), w
        at += n


def test_rows_of_the_table(spark, library):
    texts = [None, "", "Some words, and more.", "a <|endoftext|> b", "many words come here " * 5000, "Some words, and more."]
    rows = [(i % 5, t, "clash", "clash", "clash") for i, t in enumerate(texts)] + [(None, "null id", "", "", "")]
    docs = spark.createDataFrame(rows, DOCS)
    expected = []
    for doc_id, t, *_ in rows:
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((str(doc_id), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    got = pair_index.digests(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted(e[:4] for e in expected)
    tokens = pair_index.encode(docs)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in tokens.collect()) == sorted((e[0], e[4]) for e in expected)
    assert sorted((str(r["doc_id"]), r["text"]) for r in pair_index.decode(tokens).collect()) == sorted((e[0], e[5]) for e in expected)
    assert pair_index.digests(docs.limit(0)).count() == 0
