"""The documents' way to packed training sequences: language, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), docs being the documents that its predecessor kept, with the columns of
``documents``. All but the last return such documents; the last returns the packing. Each works on all rows it gets:

* ``language_id`` drops documents without a language: null, empty or without letters, and those whose language is
  anyone's guess: a score 5 % below the least of any labelled row that was identified. How much that drops depends on
  the hardest of those rows; random letters that score as high as it does stay.
* ``toxicity`` drops documents that the last model of the chain calls toxic.
* ``near_duplicates`` keeps one document of each group linked by 80 % or more common five-word n-grams, that with the
  smallest id; documents without words are linked with nothing and stay.
* ``packing`` packs what is left.

Each row of a repeated doc_id is decided by its own text; of rows with one id and text, near_duplicates keeps one. Null
ids are dropped by the first stage. Empty inputs give empty results. Columns besides those of ``documents`` are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import language_id, ngram_join, pattern_packing, toxicity_chain
from tidegate.llm.queries import toxicity_model
from tidegate.llm.shared import bucket_of, store, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(bucket_of("doc_id", 5) != 0))
    return language_id.keep_identified(docs.select(*COLUMNS), model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_chain.keep_clean(docs.select(*COLUMNS), toxicity_model(spark, sf_dir, docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    rows = store(ngram_join.ngram_join(docs, words=5, percent=80, with_groups=True), "groups").where("group is not null")
    # Of each group, the row with the smallest id, of several texts of that id one.
    kept = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("kept")).select("kept.doc_id", "kept.text_hash")
    gone = rows.select("doc_id", "text_hash").distinct().join(kept, (rows.doc_id.eqNullSafe(kept.doc_id)) & (rows.text_hash == kept.text_hash), "left_anti")
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    left = hashed.join(gone, hashed.doc_id.eqNullSafe(gone.doc_id) & (hashed.text_hash == gone.text_hash), "left_anti")
    # Rows that repeat an id and a text have one group and one decision.
    return left.dropDuplicates(["doc_id", "text_hash"]).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

# The models and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
