"""Each operator against brute force, and on nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.llm import (compression_bands, embedding_tiles, language_id, ngram_join, ordinal_quality, pattern_packing, piece_lattice,
                          suffix_tree, token_files, tokens, toxicity_chain)
from tidegate.llm.shared import bucket_of, components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, rep long, label string, gram long, component long, word string"
LONG = "many words come here and there " * 4000
TEXTS = [None, "", " \n\t ", "one", "ONE", "a b c", "the same text of several words that two rows have in common today", "the same text of several words that two rows have in common today",
         "the same text of several words that two rows have in common now", LONG, LONG + "end", "x" * 50_000, "é漢字 ▁ \U0001F600\x00 ok", "12345 !!! ???", "a <|endoftext|> b"]


def rows(texts, lang="en"):
    return [(i, t, lang, "s", len(t or ""), 7, 7, "clash", 7, 7, "clash") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """All odd texts, the last row twice."""
    data = rows(TEXTS)
    return spark.createDataFrame([*data, data[-1]], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return (text or "").encode().split()


# -- tokens, files, packing ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def whole():
    tokenizer = tokens.Tokenizer.from_file(tokens.vocabulary())
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_by_parts_are_those_of_the_whole_text(whole):
    random.seed(3)
    bits = ["a", "B", "'s", " ", "  ", "\n", "\n\n", "\t", "é", "漢", "1", "!", "\xa0", "　", "<|endoftext|>", "don't", "\r\n", " x", "ʼ", "ß..", "²", "'ll"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 9))) for _ in range(3000)] + TEXTS[:9] + TEXTS[12:]
    ids, begins = tokens.Encoder(tokens.vocabulary(), cache_parts=50).encode(pa.array(texts))
    for t, a, b in zip(texts, begins, begins[1:]):
        assert ids[a:b].tolist() == whole(t), repr(t)
    assert whole("a <|endoftext|> b") == [64, 220, 50256, 275]

    plain = tokens.Tokenizer.from_file(tokens.vocabulary())
    plain.encode_special_tokens = True
    ids, begins = tokens.Encoder(tokens.vocabulary(), cache_parts=50, specials=False).encode(pa.array(texts))
    for t, a, b in zip(texts, begins, begins[1:]):
        assert ids[a:b].tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_give_back_ids_and_texts(spark, odd, whole, tmp_path):
    token_files.write_token_files(odd, str(tmp_path / "t"))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(spark, str(tmp_path / "t")).collect())
    start, expected = 0, []
    for r in sorted(odd.collect(), key=lambda r: r["doc_id"]):
        ids = [*whole(r["text"]), 0]
        expected.append((start, r["doc_id"], len(ids), crc(ids)))
        start += len(ids)
    assert got == expected
    files = token_files.read_documents(spark, str(tmp_path / "t"), ("ids",))
    texts = {r["doc_id"]: r["text"] for r in token_files.decode(files).collect()}
    assert texts == {r["doc_id"]: r["text"] or "" for r in odd.collect()}


def test_token_files_of_an_empty_table(spark, none, tmp_path):
    token_files.write_token_files(none, str(tmp_path / "t"))
    assert token_files.digests(spark, str(tmp_path / "t")).count() == 0


def test_metadata_is_read_without_ids(spark, odd, tmp_path):
    token_files.write_token_files(odd, str(tmp_path / "t"))
    plan = token_files.read_documents(spark, str(tmp_path / "t")).where("doc_id = 3")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0] and "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,3)" in plan


def check_packing(got, docs, whole, size):
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r["sequence_id"]].append(r)
    for held in pieces.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    expected = collections.Counter()
    for r in docs:
        ids = [*whole(r["text"]), 0]
        edges = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
        expected.update((r["doc_id"], k, a, b - a, crc(ids[a:b])) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    return len(pieces)


def test_packing_places_every_piece_once(odd, none, whole):
    for size in (16, 2048):
        check_packing(pattern_packing.pack(odd, size=size).collect(), odd.collect(), whole, size)
    assert pattern_packing.pack(none).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_the_histogram_exactly_and_is_as_tight_as_best_fit(seed):
    rng = np.random.default_rng(seed)
    size = 256
    lengths = np.clip(np.exp(rng.normal(4, 1.0, 4000)).astype(int), 1, size)
    histogram = np.bincount(lengths, minlength=size + 1)
    plan = pattern_packing.make_plan(histogram)
    used = np.zeros_like(histogram)
    for n, held in plan:
        assert n > 0 and sum(held) <= size
        for v in held:
            used[v] += n
    assert (used == histogram).all()
    sequences = sum(n for n, _ in plan)
    assert sequences <= sum(n for n, _ in pattern_packing.best_fit(histogram.copy(), size)) + 1
    assert sequences <= math.ceil((histogram * np.arange(size + 1)).sum() / size) * 1.02 + 1


# -- pieces --------------------------------------------------------------------------------------------------------


def every_score(vocabulary, text, n):
    text, found = " " + text, []

    def go(i, score):
        if i == len(text):
            return found.append(score)
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in vocabulary.pieces:
                go(j, score + vocabulary.pieces[text[i:j]][1])
        if text[i] not in vocabulary.pieces:
            go(i + 1, score + vocabulary.byte_score * len(text[i].encode()))

    go(0, 0)
    return [s / 1e6 for s in sorted(found)[::-1][:n]]


def test_n_best_segmentations_are_the_best_and_decode():
    own = piece_lattice.Segmenter(piece_lattice.default_model(), 4)
    random.seed(1)
    texts = ["".join(random.choices(["the", "a", "n", " ", "  ", ".", "\n", "é", "漢", "▁", "ing"], k=random.randint(1, 5)))[:9] for _ in range(150)]
    for text, best in zip(texts, own.segment(pa.array(texts))):
        assert [s for s, *_ in best] == pytest.approx(every_score(own.vocabulary, text, 4))
        assert len({tuple(ids) for _, ids, _ in best}) == len(best)
        for _, ids, _ in best:
            assert own.vocabulary.decode(ids.tolist()) == text


def test_segmentations_of_odd_texts(odd, none):
    got = piece_lattice.segmentations(odd)
    back = {(r["doc_id"], r["rank"]): r["decoded"] for r in piece_lattice.decoded(got).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect()}
    assert {d for d, _ in back} == set(texts) and all(t == texts[d] for (d, _), t in back.items())
    assert got.where("doc_id = 0").count() == 1 and got.where("doc_id = 9").count() == 3
    assert piece_lattice.segmentations(none).count() == 0


# -- rules ---------------------------------------------------------------------------------------------------------


def test_base_measures_by_brute_force(odd, none):
    got = {r["doc_id"]: r for r in compression_bands.compression_rules(odd).collect()}
    for r in odd.collect():
        text, w = r["text"] or "", words(r["text"])
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = {x for x, n in collections.Counter(windows).items() if n > 1}
        marked = {i + k for i, x in enumerate(windows) if x in often for k in range(3)}
        lines = [x for x in text.split("\n") if words(x)]
        expected = (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))
        row = got[r["doc_id"]]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == expected
        assert row["base_failed"] == (len(w) < 50 or 100 * len(marked) > 50 * len(w)) and not (row["base_failed"] and row["kept"])
    assert compression_bands.compression_rules(none).count() == 0


def test_bands_reject_random_and_repetitive_text(spark):
    random.seed(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    vocabulary = ["".join(random.choices("etaoinshrdlu", k=random.randint(2, 8))) for _ in range(900)]
    prose = " ".join(random.choices(vocabulary, k=3000))
    noise = " ".join("".join(random.choices(letters, k=30)) for _ in range(600))
    hidden = prose + " " + " ".join(f"{i} aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" for i in range(400))
    table = spark.createDataFrame(rows([prose, noise, hidden]), DOCS)
    assert [r["verdict"] for r in compression_bands.compression_rules(table).orderBy("doc_id").collect()] == ["ok", "incompressible", "repetitive_chunks"]


# -- classifiers ---------------------------------------------------------------------------------------------------

SYLLABLES = {"en": ["the", "ing", "ous", "th", "wh"], "de": ["sch", "ein", "ung", "ber", "ich"], "fr": ["eau", "ou", "que", "tion", "ment"], "es": ["ción", "ado", "los", "que", "ar"]}


def sentence(rng, lang, n=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_languages_by_family_and_pair(spark, odd, none):
    rng = random.Random(2)
    data = [(i, sentence(rng, lang), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SYLLABLES), 400))]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language_id.train(table.where(bucket_of("doc_id", 5) != 0))
    assert [f for f, _ in model.families] == ["germanic", "romance"] and model.pairs == [("de", "en"), ("es", "fr")]
    got = {r["doc_id"]: r for r in language_id.identify(table, model).collect()}
    held = [(i, lang) for i, _, lang in data if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    strange = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(odd, model).collect()}
    assert strange[0] == strange[1] == strange[2] == strange[13] == "und" and strange[3] != "und"
    assert language_id.identify(none, model).count() == 0
    unknown = language_id.identify(odd, language_id.train(none))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    kept = language_id.keep_identified(odd, model, 0.0)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {i for i, p in strange.items() if p != "und"}


def test_toxicity_chain_finds_toxic_texts_and_leaves_others(spark, odd, none):
    rng = random.Random(4)
    data = []
    for i in range(600):
        insult, contempt = rng.random() < 0.15, rng.random() < 0.15
        text = sentence(rng, "en") + (" Idiot! " if insult else " ") + sentence(rng, "en") + (" worthless." if contempt else ".")
        data.append((i, text, int(insult), int(contempt), int(insult or contempt)))
    table = spark.createDataFrame(data, "doc_id long, text string, insult int, contempt int, toxic int")
    categories = ["insult", "contempt", "toxic"]
    model = toxicity_chain.train(table.where("doc_id % 3 > 0"), categories)
    assert [len(w) for w in model.weights] == [len(model.words) + 1 + k for k in range(3)]
    got = {r["doc_id"]: r["toxic"] for r in toxicity_chain.score(table, model).collect()}
    assert got == {r[0]: bool(r[4]) for r in data}
    assert toxicity_chain.score(odd, model).count() == len(TEXTS) + 1 and toxicity_chain.score(none, model).count() == 0
    kept = toxicity_chain.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.count() == len(TEXTS) + 1
    empty = toxicity_chain.train(table.limit(0), categories)
    assert {r["toxic"] for r in toxicity_chain.score(odd, empty).collect()} == {False}


def test_ordinal_fit_orders_thresholds_and_grades(spark, odd, none):
    rng = random.Random(6)
    data = []
    for i in range(600):
        grade = i % 3
        text = " ".join(w + ("!!" if rng.random() < (0.9, 0.4, 0.0)[grade] else "") for w in sentence(rng, "en", 60).split())
        data.append((i, text, grade))
    table = spark.createDataFrame(data, "doc_id long, text string, grade int")
    model = ordinal_quality.train(table.where("doc_id % 5 > 0"))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = [(g, r["expected_grade"], r["tail_probability"]) for (_, _, g), r in zip(data, sorted(ordinal_quality.grade(table, model).collect(), key=lambda r: r["doc_id"]))]
    means = [np.mean([e for g, e, _ in got if g == k]) for k in range(3)]
    assert means[0] < 0.4 and 0.7 < means[1] < 1.3 and means[2] > 1.6
    strange = {r["doc_id"]: r for r in ordinal_quality.grade(odd, model).collect()}
    assert strange[0]["expected_grade"] == 0 and not strange[1]["kept"]
    assert ordinal_quality.grade(none, model).count() == 0
    assert {r["kept"] for r in ordinal_quality.grade(odd, ordinal_quality.train(table.limit(0))).collect()} == {False}


# -- language model ------------------------------------------------------------------------------------------------


def test_suffix_tree_base_by_brute_force_and_probabilities_add_up(spark, odd, none):
    settings = suffix_tree.Settings(common_share=0.05, least_count=2)
    got = {r["doc_id"]: r for r in suffix_tree.score(odd, bucket_of("doc_id", 10) != 0, settings).collect()}
    texts = [(r["doc_id"], words((r["text"] or "")) ) for r in odd.collect()]
    texts = [(i, [x.lower() for x in w] + [None]) for i, w in texts]
    counts = collections.Counter(x for i, w in texts if zlib.crc32(str(i).encode()) % 10 for x in w)
    total, kinds = sum(counts.values()), len(counts)
    for i, w in texts:
        r = got[i]
        base = sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert suffix_tree.score(none, F.lit(True)).count() == 0
    untrained = suffix_tree.score(odd, F.lit(False)).where("doc_id = 3").first()
    assert untrained["score"] == pytest.approx(-4 * math.log10(256)) and untrained["n_known"] == 0 and untrained["held_out"]
    tree = suffix_tree.grow(suffix_tree.context_counts(odd, 3), suffix_tree.Settings(depth=3, least_count=2))
    assert sum(map(len, tree.contexts)) > 10
    for context in (b"\n\n\n", b"s a", b"zzz", b" th"):
        code = int.from_bytes(context, "big") << 8
        assert (10 ** tree.log10(np.arange(code, code + 256, dtype=np.uint64))).sum() == pytest.approx(1.0)


# -- pairs ---------------------------------------------------------------------------------------------------------


def reachable(nodes, linked):
    label = {i: i for i in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def brute_join(table, n, percent):
    sets = {}
    for i, t in table:
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label, links = reachable(sets, linked), collections.Counter(x for pair in linked for x in pair)
    return {i: (len(s), label[i], links[i]) for i, s in sets.items()}


@pytest.mark.parametrize("n, percent, tile", [(4, 85, 400_000), (5, 80, 60), (2, 50, 60)])
def test_ngram_join_by_brute_force(spark, n, percent, tile):
    rng = random.Random(n)
    base = [sentence(rng, "en", rng.randint(3, 60)) for _ in range(25)]
    passage = sentence(rng, "de", 30)
    texts = list(TEXTS[:9])
    for _ in range(120):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(["new", "NEW", "other"])
        texts.append(" ".join(w) + (" " + passage if rng.random() < 0.3 else ""))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.ngram_join(spark.createDataFrame(rows(texts), DOCS), n, percent, tile).collect()}
    assert got == brute_join(list(enumerate(texts)), n, percent)


def test_ngram_join_of_odd_tables(odd, none):
    got = ngram_join.ngram_join(odd).collect()
    assert len(got) == len(TEXTS) + 1
    by = {r["doc_id"]: r for r in got}
    assert by[0]["component_id"] == 0 and by[2]["n_links"] == 0 and by[4]["component_id"] == 3 and by[10]["component_id"] == 9
    assert ngram_join.ngram_join(none).count() == 0


@pytest.mark.parametrize("tile", [400_000, 60])
def test_ngram_join_of_ids_with_several_texts(spark, tile):
    rng = random.Random(8)
    a, b, c = (sentence(rng, lang, 60) for lang in ("en", "de", "en"))
    near = lambda t: t + " tail"
    table = [(5, near(a)), (5, near(b)), (5, c), (3, near(b)), (2, b), (8, a), (9, near(c)), (1, "alone"), (1, "by itself")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.ngram_join(docs, tile_ngrams=tile).collect())
    assert got == [(1, 1), (1, 1), (2, 2), (3, 2), (5, 2), (5, 5), (5, 5), (8, 5), (9, 5)]


def test_embedding_links_by_brute_force(spark, none):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 20))
    data = [(i, (centres[i % 6] + rng.normal(size=20) * rng.choice([0.05, 0.1, 0.3])).astype(np.float32).tolist(), i % 2, 7, 7) for i in range(300)]
    data += [(300 + i, data[0][1], 0, 7, 7) for i in range(5)]
    bad = [None, [], [0.0] * 20, [1.0] * 19 + [None], [float("nan")] * 20, [float("inf")] + [0.0] * 19]
    data += [(400 + i, v, 0, 7, 7) for i, v in enumerate(bad)] + [(420, data[0][1], None, 7, 7), (421, [1.0, 2.0], 0, 7, 7), (422, [2.0, 4.0], 0, 7, 7), (423, [5.0], 0, 7, 7)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, rep long, copies long")
    sound = {i: (label, np.array(v, float)) for i, v, label, *_ in data if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    linked = [(a, b) for a, b in itertools.combinations(sound, 2) if sound[a][0] == sound[b][0] and len(sound[a][1]) == len(sound[b][1])
              and sound[a][1] @ sound[b][1] / np.linalg.norm(sound[a][1]) / np.linalg.norm(sound[b][1]) >= 0.98]
    label, links = reachable([r[0] for r in data], linked), collections.Counter(x for pair in linked for x in pair)
    for tile in (16, 1024):
        got = {r["vec_id"]: tuple(r) for r in embedding_tiles.embedding_links(table, 0.98, tile).select("vec_id", "n_links", "component_id", "kept").collect()}
        assert got == {i: (i, links[i], label[i], label[i] == i) for i in label}
    assert embedding_tiles.embedding_links(table.limit(0)).count() == 0


def test_early_stop_changes_no_link():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 40)), rng.normal(size=(50, 40))
    y[:20] = x[:20] + 0.1 * rng.normal(size=(20, 40))
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    cosine = embedding_tiles.unit(x) @ embedding_tiles.unit(y).T
    for least in (0.0, 0.5, 0.98, 0.995):
        assert (embedding_tiles.linked(x, y, turn, least) == (cosine >= least)).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == reachable({x for e in edges for x in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_toxicity_keeps_every_word_that_passes(spark):
    rng = random.Random(12)
    kinds = [f"slur{k}x" for k in range(300)]
    data = [(i, f"{sentence(rng, 'en')} {kinds[i % 300] if i % 2 else ''} {sentence(rng, 'en')}", i % 2) for i in range(6000)]
    table = spark.createDataFrame(data, "doc_id long, text string, toxic int").repartition(8)
    model = toxicity_chain.train(table, ["toxic"], toxicity_chain.Settings(least_ratio=10))
    # Odd numbers meet 150 of the 300 words, twenty rows each.
    assert {w.decode() for w in model.words} >= {kinds[k] for k in range(1, 300, 2)}
    texts = [f"{sentence(rng, 'en')} {kinds[k]}" for k in range(1, 300, 2)]
    assert (model.probabilities([t.encode() for t in texts])[:, 0] >= model.settings.limit).all()
    assert model.probabilities([sentence(rng, "en").encode()])[0, 0] < model.settings.limit


def test_toxicity_fit_by_dense_newton_steps():
    rng = np.random.default_rng(3)
    n, words = 400, 700
    dense = (rng.random((n, words)) < 0.02).astype(float)
    y = (dense[:, :40].sum(axis=1) + rng.normal(size=n) > 1).astype(float)
    extra = rng.random((n, 2))
    x = toxicity_chain.features_of([list(np.flatnonzero(r)) for r in dense], words)
    for k in range(2):
        x = x.with_column(extra[:, k])
    whole = np.hstack([dense, extra, np.ones((n, 1))])
    ridge = np.full(words + 3, 1e-3 * n)
    ridge[-1] = 1e-6
    ridge += 1e-9
    w = np.zeros(words + 3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-whole @ w))
        w -= np.linalg.solve((whole * (p * (1 - p))[:, None]).T @ whole + np.diag(ridge), whole.T @ (p - y) + ridge * w)
    assert toxicity_chain.fit(x, y, 1e-3, 50) == pytest.approx(w, abs=1e-4)
    own = np.arange(n) % 3 == 0
    assert x.where(own).times(w) == pytest.approx(whole[own] @ w)


def test_ngram_join_adds_up_partial_overlaps_of_many_tiles(spark, monkeypatch):
    rng = random.Random(31)
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 7)
    base = sentence(rng, "en", 40).split()
    texts = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(len(w))] = f"new{k}"
        texts.append(" ".join(w))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.ngram_join(spark.createDataFrame(rows(texts), DOCS), 4, 80).collect()}
    assert got == brute_join(list(enumerate(texts)), 4, 80)
