"""Similarity join of documents on word n-grams by Jaccard, with vertical partitioning of the n-grams.

The n-grams of all documents have one global order (by 64-bit hash), cut into ``FRAGMENTS`` ranges, the same for every
document. Overlaps are counted per pair and fragment, each fragment in rows and tasks of its own, and summed per pair.
Three facts keep the work small, and none of them loses a pair: let a document have n distinct n-grams,
d = n - ceil(percent * n / 100).

1. A partner has all but d of its n-grams at least. So a document with more than d n-grams in a first part of the order
   that no other text has is linked with none. That part, 30 % of the n-grams, settles most documents.
2. Among the rest, order n-grams by frequency, rarest first. Two linked documents share one of their first d + 1
   n-grams. Documents that share one fall into one candidate group (connected components of links to the smallest
   document of each n-gram; no pairs are formed).
3. Links lie within candidate groups. A group is cut into tiles of a bounded number of n-grams and of documents. For
   each two tiles and each fragment, a row holds the n-grams of that fragment alone; its partial overlaps are one block
   of numbers. A pair whose sets differ more in one fragment than linked sets may differ in all is given up there. The
   blocks of two tiles are added up, one sum per pair, which gives, per document, its number of links and the smallest
   document that it reaches inside the two tiles.

Documents with equal sets are one class and take part once; a class's key has 128 bits. N-grams are told apart by 64
bits.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a document with fewer words than an n-gram has its whole
sequence as its only one. Null and empty texts and texts without words have no n-grams and are linked with nothing:
n_shingles 0, component_id their own id. Repeated rows each get a row. Classes have numbers of their own, so rows that
give one id several texts each get the component of their own text, and rows without an id take part like any other:
their links count, and their component_id is the smallest id that they reach, null if there is none. An empty table
gives none; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import as_bytes, chunks, components, local_labels, store, words_of

#: Share of the n-gram order that settles most documents.
FIRST_SHARE = 0.3
#: Ranges that the n-gram order is cut into, a power of 2.
FRAGMENTS = 4
#: About so many n-grams, over all fragments, and so many documents has a tile, unless one document has more n-grams.
TILE_NGRAMS = 400_000
TILE_DOCS = 512
#: Distinct n-grams that are multiplied at once.
BLOCK_COLUMNS = 4096

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _M
    return h ^ (h >> np.uint64(32))


def ngrams(text: bytes | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct n-grams."""
    found = words_of(text.lower()) if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(h))
    total = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        total = total * _K + h[k : len(h) - n + 1 + k]
    return np.unique(_mixed(total + np.uint64(n)))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def ngram_sets(docs: DataFrame, words: int, share: float) -> DataFrame:
    """Per document: doc_id, text_hash, n (distinct n-grams), key_a and key_b (128 bits of the set), grams (those in the
    first ``share`` of the order)."""
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = [ngrams(t, words) for t in as_bytes(batch.column("text"))]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            first = sets if share >= 1 else [s[: np.searchsorted(s, limit)] for s in sets]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), _lists(first)],
                names=["doc_id", "text_hash", "n", "key_a", "key_b", "grams"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n long, key_a long, key_b long, grams array<long>")


@dataclass
class Side:
    """One tile's documents, by rep, with their n-grams in one fragment: document ``row[i]`` has ``gram[i]``."""

    rep: np.ndarray
    n: np.ndarray
    copies: np.ndarray
    row: np.ndarray
    gram: np.ndarray


def side_of(members: pa.StructArray) -> Side:
    field = lambda k: pc.struct_field(members, k)
    number = lambda k: field(k).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(number("rep"))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    grams = field("grams")
    row = np.repeat(place, pc.list_value_length(grams).to_numpy(zero_copy_only=False))
    return Side(number("rep")[order], number("n")[order], number("copies")[order], row, grams.flatten().to_numpy())


def overlaps(left: Side, right: Side) -> np.ndarray:
    """Shared n-grams of each left and right document."""
    own = len(left.rep)
    same = right is left
    row = left.row if same else np.concatenate([left.row, right.row + own])
    gram = left.gram if same else np.concatenate([left.gram, right.gram])
    _, code = np.unique(gram, return_inverse=True)
    often = np.bincount(code) > 1
    number = np.cumsum(often) - 1
    keep = often[code]
    code, row = number[code[keep]], row[keep]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    total = np.zeros((own, len(right.rep)), np.float32)
    last = int(code[-1]) + 1 if len(code) else 0
    for low in range(0, last, BLOCK_COLUMNS):
        a, b = np.searchsorted(code, [low, low + BLOCK_COLUMNS])
        part = np.zeros((own if same else own + len(right.rep), min(BLOCK_COLUMNS, last - low)), np.float32)
        part[row[a:b], code[a:b] - low] = 1
        total += part[:own] @ (part if same else part[own:]).T
    return np.rint(total).astype(np.int32)


def partial_block(left: Side, right: Side, percent: int) -> np.ndarray:
    """The overlaps in one fragment; -1 for pairs that differ too much in it to be linked."""
    shared = overlaps(left, right)
    size = lambda s: np.bincount(s.row, minlength=len(s.rep))
    # Linked: 100 * o >= percent * (a + b - o), so a + b - 2 * o, over all fragments, is (100 - percent) / (100 + percent) of a + b at most.
    differ = size(left)[:, None] + size(right)[None, :] - 2 * shared.astype(np.int64)
    shared[(100 + percent) * differ > (100 - percent) * (left.n[:, None] + right.n[None, :])] = -1
    return shared


def linked(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (a[:, None] + b[None, :] - overlap)


def summed_links(blocks: list[np.ndarray], reps: list[np.ndarray], sizes: list[np.ndarray], copies: list[np.ndarray], percent: int) -> list[tuple[int, int, int]]:
    """(document, smallest document reached, links weighted by class sizes) for documents with a link in these tiles.

    ``reps``, ``sizes`` and ``copies`` have an entry for each tile, one or two.
    """
    given_up = np.zeros(blocks[0].shape, bool)
    total = np.zeros(blocks[0].shape, np.int64)
    for block in blocks:
        given_up |= block < 0
        total += block
    joined = linked(total, sizes[0], sizes[-1], percent) & ~given_up
    if len(reps) == 1:
        np.fill_diagonal(joined, False)
        docs, whole = reps[0], joined
        counts = joined @ copies[0]
    else:
        own = len(reps[0])
        docs = np.concatenate(reps)
        whole = np.zeros((len(docs), len(docs)), bool)
        whole[:own, own:] = joined
        whole[own:, :own] = joined.T
        counts = np.concatenate([joined @ copies[1], joined.T @ copies[0]])
    some = np.flatnonzero(whole.any(axis=1))
    order = some[np.argsort(docs[some])]
    labels = local_labels(whole[np.ix_(order, order)])
    return [(int(docs[i]), int(docs[order[k]]), int(counts[i])) for i, k in zip(order, labels)]


_LISTS = ("reps", "sizes", "copies", "other_reps", "other_sizes", "other_copies")
#: The first fragment's row names the documents, the others have nulls there. Blocks given up as a whole are left out.
PARTIAL = "component long, tile int, next int, fragment int, block binary, " + ", ".join(f"{c} array<long>" for c in _LISTS)


def _count(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one pair of tiles at a time
                row = batch.slice(i, 1)
                left = side_of(row.column("members").flatten())
                alone = row.column("other").null_count == 1
                right = left if alone else side_of(row.column("other").flatten())
                block = partial_block(left, right, percent)
                first = row.column("fragment")[0].as_py() == 0
                lists = [left.rep, left.n, left.copies, *([None] * 3 if alone else [right.rep, right.n, right.copies])]
                if not (block >= 0).any():
                    continue
                kept = [pa.array([x if first else None], pa.list_(pa.int64())) for x in lists]
                yield pa.record_batch([*(row.column(k) for k in ("component", "tile", "next", "fragment")), pa.array([block.tobytes()], pa.binary()), *kept],
                                      names=["component", "tile", "next", "fragment", "block", *_LISTS])

    return run


def _add_up(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i] for k in ("blocks", *_LISTS)}
                lists = {k: np.array(row[k].as_py(), np.int64) for k in _LISTS if row[k].is_valid}
                tiles = ["", "other_"] if "other_reps" in lists else [""]
                of = lambda k: [lists[t + k] for t in tiles]  # noqa: E731,B023
                shape = (len(of("reps")[0]), len(of("reps")[-1]))
                blocks = [np.frombuffer(b, np.int32).reshape(shape) for b in row["blocks"].as_py()]
                rows += summed_links(blocks, of("reps"), of("sizes"), of("copies"), percent)
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "links"])

    return run


def group_links(members: DataFrame, percent: int, tile_ngrams: int) -> DataFrame:
    """(a, b, links) from rows (component, rep, n, copies, grams): partial counts per fragment, one sum per pair."""
    tiles = F.greatest(F.ceil(F.sum("n") / tile_ngrams), F.ceil(F.count("*") / TILE_DOCS)).cast("int")
    large = store(members.groupBy("component").agg(tiles.alias("tiles")).where("tiles > 1"), "large")
    bits = FRAGMENTS.bit_length() - 1
    fragment = F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment")
    within = lambda g: F.shiftrightunsigned(g, 64 - bits) == F.col("fragment")
    cut = members.join(large, "component", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    cut = cut.select("component", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int").alias("tile"), "tiles", "rep", "n", "copies", "grams", fragment)
    cut = cut.withColumn("grams", F.filter("grams", within))
    # By name: dealt by the component alone, a large group would meet in one task.
    cut = cut.repartition("component", "tile", "fragment")
    key = ["component", "tile", "fragment"]
    sides = store(cut.groupBy(*key, "tiles").agg(F.collect_list(F.struct("rep", "n", "copies", "grams")).alias("members")), "tiles")
    alone = sides.select(*key, F.col("tile").alias("next"), "members", F.lit(None).cast(sides.schema["members"].dataType).alias("other"))
    several = sides.where("tiles > 1")
    ahead = several.where("tile < tiles - 1").select(*key, "members", F.explode(F.sequence(F.col("tile") + 1, F.col("tiles") - 1)).alias("next"))
    after = several.select("component", F.col("tile").alias("next"), "fragment", F.col("members").alias("other"))
    pairs = ahead.join(after, ["component", "next", "fragment"]).select(*key, "next", "members", "other")
    partial = alone.unionByName(pairs).mapInArrow(_count(percent), PARTIAL)
    named = [F.max(c).alias(c) for c in _LISTS]
    sums = partial.groupBy("component", "tile", "next").agg(F.collect_list("block").alias("blocks"), *named)
    return store(sums.where(F.size("blocks") == FRAGMENTS).mapInArrow(_add_up(percent), "a long, b long, links long"), "links")


def ngram_join(docs: DataFrame, words: int = 5, percent: int = 80, tile_ngrams: int = TILE_NGRAMS, with_groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links (other documents with Jaccard of percent / 100 or more).

    ``with_groups`` adds text_hash, the xxhash64 of the text, and group, a number of the component that does not depend
    on ids, null for documents without n-grams.
    """
    missing = lambda n: n - F.ceil(F.lit(percent) * n / 100)  # noqa: E731  at exact multiples, percent * n / 100 is exact
    sets = store(ngram_sets(docs, words, FIRST_SHARE), "sets")
    classes = sets.where("n > 0").groupBy("key_a", "key_b").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.count("*").alias("copies"))
    # Numbered once and stored, so the numbers stay.
    classes = store(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")

    # Fact 1. Copies count once: all of a class's rows have one key.
    grams = sets.select("key_a", F.explode("grams").alias("gram"))
    single = grams.groupBy("gram").agg(F.min("key_a").alias("key_a"), F.max("key_a").alias("most")).where("key_a = most")
    single = single.groupBy("key_a").agg(F.count("*").alias("single"))
    left = classes.join(single, "key_a", "left").where(F.coalesce("single", F.lit(0)) <= missing(F.col("n")))
    left = store(left.select("key_a", "key_b", "rep", "least", "copies"), "left")

    # All n-grams of those that are left: one row of each class, found by its smallest id, among those
    # without an id where it has none. A doc_id may have several texts, so classes are told apart by their keys.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The ids grow with the table, so they are merged at every size: the same plan for small and large inputs.
    text = rows.join(left.select(F.col("least").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    if not left.where("least is null").isEmpty():
        text = text.unionByName(rows.where("doc_id is null"))
    full = ngram_sets(text, words, 1.0).where("n > 0").join(left, ["key_a", "key_b"])
    full = store(full.where("doc_id <=> least").dropDuplicates(["key_a", "key_b"]).select("key_a", "rep", "n", "copies", "grams"), "full")
    # Fact 2: links to the smallest document of each of the first n-grams.
    grams = full.select("key_a", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    ordered = grams.join(often, "gram").groupBy("key_a").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("shared"))
    first = ordered.join(full.select("key_a", "rep", "n"), "key_a")
    lone = F.col("n") - F.size("shared")  # come first in the order and have no partner
    first = first.where(missing(F.col("n")) + 1 - lone > 0)  # else fact 1 holds
    first = first.select("rep", F.explode(F.slice("shared", F.lit(1), (missing(F.col("n")) + 1 - lone).cast("int"))).alias("s"))
    first = store(first.select("rep", F.col("s.gram").alias("gram")), "first")
    hubs = first.groupBy("gram").agg(F.min("rep").alias("hub"), F.count("*").alias("df")).where("df > 1").select("gram", "hub")
    groups = components(first.join(hubs, "gram").select(F.col("rep").alias("a"), F.col("hub").alias("b")))

    # Fact 3.
    members = store(full.join(groups.withColumnRenamed("node", "rep"), "rep").select("component", "rep", "n", "copies", "grams"), "members")
    links = group_links(members, percent, tile_ngrams)

    found = store(components(links.select("a", "b")).withColumnRenamed("node", "rep"), "found")
    counts = links.groupBy("a").agg(F.sum("links").alias("links"))
    smallest = found.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("smallest"))
    classes = (
        classes.join(found.join(smallest, "component"), "rep", "left")
        .join(counts.withColumnRenamed("a", "rep"), "rep", "left")
        .select("key_a", "key_b", F.coalesce("component", "rep").alias("group"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("smallest"),
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return sets.select("doc_id", "text_hash", "n", "key_a", "key_b").join(classes, ["key_a", "key_b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        *(["text_hash", "group"] if with_groups else []))
