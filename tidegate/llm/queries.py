"""One query per operator, over whole tables with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import scratch_folder
from tidegate.llm import alignment, compression_bands, embedding_tiles, language_id, ngram_join, ordinal_quality, pair_index, pattern_packing, piece_lattice, prefix_trie, suffix_tree, token_files, toxicity_chain
from tidegate.llm.shared import bucket_of, table

# Seeds of the weakly labelled categories: a labelled toxic text with one of them has the category.
SEEDS = {
    "insult": ("idiot", "moron", "loser", "clown", "scum", "fool"),
    "contempt": ("pathetic", "worthless", "disgusting", "trash", "stupid", "garbage"),
}
CATEGORIES = [*SEEDS, "toxic"]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(bucket_of("doc_id", 5) != 0))
    held_out = (bucket_of("doc_id", 5) == 0).alias("held_out")
    return language_id.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def labelled(spark: SparkSession, sf_dir: str, docs: DataFrame, most: int) -> DataFrame:
    """Documents with their labels; the sample of labels has a bounded size, so it may be broadcast."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    picked = toxicity_chain.training_sample(labels.where(bucket_of("doc_id", 5) != 0), most).dropDuplicates(["doc_id"])
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity_chain.Model:
    rows = labelled(spark, sf_dir, docs, toxicity_chain.Settings().training_rows)

    def seeded(words: tuple[str, ...]) -> Column:
        return ((F.col("toxic") == 1) & F.lower("text").rlike(rf"\b({'|'.join(words)})\b")).cast("int")

    rows = reduce(lambda df, c: df.withColumn(c, seeded(SEEDS[c])), SEEDS, rows)
    return toxicity_chain.train(rows, CATEGORIES)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_chain.score(docs, toxicity_model(spark, sf_dir, docs))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands.compression_rules(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 for low quality, 1 for good but toxic, 2 for good."""
    docs = table(spark, sf_dir, "documents")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    rated = labelled(spark, sf_dir, docs, 3 * ordinal_quality.Settings().training_rows).withColumn("grade", grade)
    return ordinal_quality.grade(docs, ordinal_quality.train(rated))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"), bucket_of("doc_id", 10) != 0)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.segmentations(table(spark, sf_dir, "documents"), with_ids=False, with_decoded=True)


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), words=4, percent=85)


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_tiles.embedding_links(table(spark, sf_dir, "embeddings"), least=0.98)


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.digests(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_index.digests(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_toxicity, op3_quality_rules, op4_quality_classifier, op5_best_fit_packing, op6_lm_scoring, op7_sentencepiece, op8_ngram_join, op9_embedding_near_dedup, op10_token_output, op11_prefix_trie, op12_bpe, op13_alignment)}
ORACLES: dict[str, str] = {
    "op9_embedding_near_dedup": """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (
    SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a), least_of AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN least_of ON vec_id = least_of.a
""",
    # crc32 by its table of 256 remainders; a node is the list of its turns.
    "op11_prefix_trie": """
WITH crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) AS r(i))
), own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
    SELECT own.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM own, crc_table
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(f.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM headed c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 100
), member AS (
    SELECT conv_id, turns[1:d] AS node, d, d = len(turns) AS ends FROM rebuilt, unnest(range(len(turns) + 1)) AS u(d)
), node AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(array_to_string(coalesce(list(conv_id ORDER BY conv_id) FILTER (WHERE ends), []), ',')) AS ends_sha256
    FROM member GROUP BY node, d
), kids AS (
    SELECT n.node, n.d, n.conv_id, n.n_convs, n.ends_sha256, any_value(p.conv_id) AS parent_conv_id, count(k.node) AS n_children,
        CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.node[n.d].text) END AS saved
    FROM node n LEFT JOIN node p ON n.d > 0 AND p.d = n.d - 1 AND p.node = n.node[1:n.d - 1] LEFT JOIN node k ON k.d = n.d + 1 AND k.node[1:n.d] = n.node
    GROUP BY n.node, n.d, n.conv_id, n.n_convs, n.ends_sha256
), subtree AS (
    SELECT node[1:u.d] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM kids, unnest(range(kids.d + 1)) AS u(d) GROUP BY 1
)
SELECT conv_id::BIGINT AS conv_id, d::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM kids JOIN subtree USING (node)
""",
}
