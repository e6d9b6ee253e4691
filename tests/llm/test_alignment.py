"""The alignment of two tokenizers against a comparison of all byte ranges."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidegate.llm import alignment

DOCS = "doc_id long, text string, row long, pairs long, n long"
TEXTS = [None, "", " ", "one", "one", "Some words, and more of them.", "<|endoftext|> <s> </s> <unk> <0x41>", "two  spaces\n\nand\ttabs", "漢字 \U0001F600\x00 ok", "▁ is the mark of a space", "ﬁ ½ é é",
         "many words come here " * 3000, "x" * 3000, "Ütliche Größe über alles", "12345 !!! ???", "a", "trailing ", "\nleading", " leading", "a \u2581b", "line\nends here\n", "a\n"]


@pytest.fixture(scope="module")
def brute():
    path_a, path_b = alignment.vocabularies()
    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}

    def spell(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [spell(i) for i in ids_b]
        return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode() else None

    def ranges(pieces):
        ends = np.cumsum([len(p) for p in pieces]).tolist()
        return list(zip([0, *ends], ends))

    def document(text):
        found = tokens(text)
        if found is None:
            return 0, 0, 0, [], ""
        ids_a, bytes_a, ids_b, bytes_b = found
        ra, rb = ranges(bytes_a), ranges(bytes_b)
        links, j = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        texts = []
        for s, e in zip([0, *cuts], cuts):
            texts.append(",".join(str(i) for i, r in zip(ids_a, ra) if s < r[1] <= e) + "|" + ",".join(str(i) for i, r in zip(ids_b, rb) if s < r[1] <= e) if len(ra) < 5000 else "")
        return len(ids_a), len(ids_b), len(cuts), links, hashlib.sha256(";".join(texts).encode()).hexdigest() if len(ra) < 5000 else None

    def table(rows):
        docs = [document(t) for _, t in rows]
        count = collections.Counter(p for d in docs for p in d[3])
        best = collections.Counter()
        for (_, b_id), n in count.items():
            best[b_id] = max(best[b_id], n)
        return [(i, d[0], d[1], d[2], len(d[3]), sum(count[p] == best[p[1]] for p in d[3]), sum(count[p] for p in d[3]), d[4]) for (i, _), d in zip(rows, docs)]

    return table


def same(got, expected):
    got = sorted(map(tuple, got), key=str)
    for g, e in zip(got, sorted(expected, key=str), strict=True):
        assert g[:7] == e[:7] and e[7] in (None, g[7]), (g, e)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], DOCS)


def made(n):
    rng = random.Random(2)
    bits = ["the", "ing", "ther", "Wort", "é", "漢", "\U0001F600", " ", " ", "  ", "\n", ".", ",", "123", "'s", "un", "related", "▁"]
    return [(i // 2, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(n)]


@pytest.mark.parametrize("most_head", [alignment.MOST_HEAD, 5, 0])
def test_documents_and_corpus_counts(spark, brute, most_head):
    rows = [*enumerate(TEXTS), *made(200), (None, "null id")]
    same(alignment.alignment(frame(spark, rows), most_head=most_head).collect(), brute(rows))


def test_no_rows_and_no_tokens(spark, brute):
    assert alignment.alignment(frame(spark, [(1, "x")]).limit(0)).count() == 0
    rows = [(1, None), (1, ""), (2, None)]
    same(alignment.alignment(frame(spark, rows)).collect(), brute(rows))


def test_groups_spell_the_text(spark):
    rows = [*enumerate(TEXTS)]
    own = alignment.Aligner(*alignment.vocabularies())
    got = {r["doc_id"]: r["groups"] for r in alignment.groups(frame(spark, rows)).collect()}
    for i, text in rows:
        a, b = ([x for g in got[i] for x in g[side]] for side in "ab")
        if a:
            assert own.spelling_a.join(np.array(a)) == own.spelling_b.join(np.array(b)) == b" " + text.encode()
            for g in got[i]:
                assert own.spelling_a.join(np.array(g["a"])) == own.spelling_b.join(np.array(g["b"]))
    assert sum(bool(g) for g in got.values()) > 8


def test_parts_give_the_ids_of_whole_texts():
    rng = random.Random(5)
    bits = ["the", "Wort", "é", "漢", "\U0001F600", " ", " ", " ", "\n", ".", "12", "'s", "a", "b", "xyz", "\t", "  "]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(3000)]
    own = alignment.Aligner(*alignment.vocabularies(), cache_parts=500)
    for start in range(0, len(texts), 300):
        some = texts[start : start + 300]
        for t, found in zip(some, own.documents(pa.array(some))):
            assert found[0].take("a", found[1]).tolist() == own.a.tokenizer.encode(" " + t, add_special_tokens=False).ids, repr(t)
            assert found[0].take("b", found[1]).tolist() == own.b.encode(t), repr(t)
