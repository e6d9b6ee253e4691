"""Rows without an id, ids with several texts, and texts of no language, in joins and pipeline stages."""

import random
import string

import corpus_pipeline
from tidegate.llm import embedding_tiles, language_id, ngram_join

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BASE = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"thing{i}" for i in range(60))


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_links_of_rows_without_an_id(spark):
    table = docs(spark, (None, BASE), (None, BASE), (5, BASE + " tail"), (7, BASE + " end"), (None, OTHER), (9, "quite another text of some words"), (None, ""))
    got = ngram_join.ngram_join(table, words=4, percent=80).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["n_links"]) for r in got) == sorted(
        [("None", "5", 3), ("None", "5", 3), ("5", "5", 3), ("7", "5", 3), ("None", "None", 0), ("9", "9", 0), ("None", "None", 0)])


def test_an_id_with_several_texts_keeps_their_groups_apart(spark):
    table = docs(spark, (1, BASE), (2, BASE + " tail"), (2, OTHER), (3, OTHER + " tail"), (3, "quite another text"), (3, "quite another text"), (4, ""), (4, None))
    got = {(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicate_stage(spark, table, "").collect()}
    assert got == {(1, BASE), (2, OTHER), (3, "quite another text"), (4, ""), (4, None)}


def test_vectors_without_an_id(spark):
    rows = [(None, "a", [1.0, 0.0]), (None, "a", [1.0, 0.001]), (4, "a", [1.0, 0.002]), (3, "a", [0.0, 1.0]), (None, "b", [1.0, 0.0]), (None, None, [1.0, 0.0]), (None, "a", None)]
    got = embedding_tiles.embedding_links(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == sorted(
        [("None", 2, "4", False), ("None", 2, "4", False), ("4", 2, "4", True), ("3", 0, "3", True), ("None", 0, "None", True), ("None", 0, "None", True), ("None", 0, "None", True)])


def test_texts_of_random_letters_go_and_clean_ones_stay(spark):
    rng = random.Random(4)
    parts = {"en": ["the", "ing", "and", "tion", "er", "wh"], "de": ["der", "ung", "sch", "ein", "ä", "cht"], "fr": ["que", "eau", "ment", "é", "tion", "oi"], "es": ["ción", "que", "ado", "ñ", "los", "ue"]}

    def prose(lang, words):
        return " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(words))

    rows = [(i, prose(lang, rng.randint(2, 200)), lang) for i, lang in enumerate(list(parts) * 150)]
    model = language_id.train(spark.createDataFrame(rows[:400], "doc_id long, text string, lang string"))
    assert 0.25 < model.least < 1
    clean = [(i, t, lang, "s", len(t)) for i, t, lang in rows[400:]]
    random_letters = [(1000 + i, "".join(rng.choices(string.ascii_lowercase + "   ", k=2000)), "en", "s", 2000) for i in range(30)]
    kept = {r["doc_id"] for r in language_id.keep_identified(spark.createDataFrame(clean + random_letters, DOCS), model).collect()}
    assert len(kept & {r[0] for r in clean}) >= 0.98 * len(clean)
    assert len(kept & {r[0] for r in random_letters}) <= 3
