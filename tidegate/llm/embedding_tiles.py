"""Near duplicates among embeddings of one label, compared tile by tile with coordinates in principal-component order.

Vectors are scaled to length 1 and turned so that the leading coordinates vary most; turning changes no cosine. Two
vectors with cosine t or more are at most sqrt(2 - 2 t) apart, so in each coordinate too: vectors are dealt into cells
of that width by their first two coordinates, and only cells that touch are compared. Cells are cut into tiles of a
bounded number of vectors. For two tiles, products are added up over blocks of coordinates, the leading ones first;
what the rest can add is at most the product of the two remaining norms, and pairs that cannot reach t any more are
left. A tile pair stops when none remains. Pairs that arrive at t, within rounding, are decided by the cosine of the
vectors as they were given, in double precision.

Equal vectors of a label are one class and are compared once; their links count for every copy. Only vectors with the
same label and the same number of components are compared. Null labels and vectors that are null, empty, zero or hold
null or non-finite components link with nothing: n_links 0, their own id as component_id, kept. Repeated rows each get
a row and count as other vectors. Rows without an id link like any other; their component_id is the smallest id that they
reach, and where there is none it is null and they are kept. An empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import components, local_labels, store

TILE_ROWS = 1024
#: Products within this of the threshold are decided by the given vectors.
SLACK = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps very large and very small components in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def blocks(size: int) -> list[tuple[int, int]]:
    """Coordinates in growing blocks: 8, 8, 16, 32, ..."""
    edges = [0]
    while edges[-1] < size:
        edges.append(min(size, max(8, 2 * edges[-1])))
    return list(zip(edges, edges[1:]))


def linked(left: np.ndarray, right: np.ndarray, turn: np.ndarray, least: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` have cosine ``least`` or more."""
    a, b = unit(left), unit(right)
    p, q = a @ turn, b @ turn
    rest = lambda v: np.sqrt(np.maximum(np.cumsum((v * v)[:, ::-1], axis=1)[:, ::-1], 0.0))
    rest_p, rest_q = (np.hstack([rest(v), np.zeros((len(v), 1))]) for v in (p, q))
    found = np.zeros((len(p), len(q)), bool)
    total, pairs = np.zeros((len(p), len(q))), None
    for low, high in blocks(p.shape[1]):
        if pairs is None:
            total += p[:, low:high] @ q[:, low:high].T
            alive = total + np.outer(rest_p[:, high], rest_q[:, high]) >= least - SLACK
            n = int(alive.sum())
            if n * 16 < alive.size:  # few are left: go on pair by pair
                pairs = np.nonzero(alive)
                total = total[pairs]
        else:
            i, j = pairs
            total = total + np.einsum("ij,ij->i", p[i, low:high], q[j, low:high])
            keep = total + rest_p[i, high] * rest_q[j, high] >= least - SLACK
            pairs, total = (i[keep], j[keep]), total[keep]
            n = len(total)
        if not n:
            return found
    if pairs is None:
        found = total >= least
        pairs = np.nonzero(np.abs(total - least) <= SLACK)
    else:
        found[pairs] = total >= least
        close = np.abs(total - least) <= SLACK
        pairs = pairs[0][close], pairs[1][close]
    i, j = pairs
    if len(i):
        x, y = left[i], right[j]
        found[i, j] = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) >= least
    return found


def tile_links(left: tuple, right: tuple | None, turn: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vector, smallest vector reached, links weighted by copies) of vectors linked in these tiles; a tile is (ids, copies, vectors)."""
    if right is None:
        ids, copies, x = left
        whole = linked(x, x, turn, least)
        whole |= whole.T
        np.fill_diagonal(whole, False)
        counts = whole @ copies
    else:
        ids = np.concatenate([left[0], right[0]])
        joined = linked(left[2], right[2], turn, least)
        n = len(left[0])
        counts = np.concatenate([joined @ right[1], joined.T @ left[1]])
        if not joined.any():
            return ids[:0], ids[:0], counts[:0]
        whole = np.zeros((len(ids), len(ids)), bool)
        whole[:n, n:], whole[n:, :n] = joined, joined.T
    some = np.flatnonzero(counts)
    order = some[np.argsort(ids[some])]
    labels = local_labels(whole[np.ix_(order, order)])
    return ids[order], ids[order[labels]], counts[order]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of unit vectors, by number of components: one row for each cell of the matrix."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, x in _by_size(batch.column("embedding")):
            u = unit(x[1])
            sums[size] = sums.get(size, 0) + u.T @ u
    for size, s in sums.items():
        yield pa.record_batch([pa.array(np.full(size * size, size)), pa.array(np.arange(size * size)), pa.array(s.ravel())], names=["size", "cell", "value"])


def _by_size(column: pa.ListArray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Rows and matrices of equal numbers of components."""
    offsets = column.offsets.to_numpy()
    values, lengths = column.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        yield int(size), (rows, values[offsets[rows][:, None] + np.arange(size)].astype(float))


def embedding_links(vectors: DataFrame, least: float = 0.98, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.col("label").isNotNull() & F.coalesce(finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    classes = rows.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    # Numbered once and stored, so the numbers stay; rows without an id take part like any other.
    classes = store(classes.withColumn("rep", F.monotonically_increasing_id()), "vectors")

    sums: dict[int, np.ndarray] = {}
    for r in classes.select("embedding").mapInArrow(_sums, "size long, cell long, value double").groupBy("size", "cell").agg(F.sum("value").alias("value")).collect():
        sums.setdefault(r["size"], np.zeros(r["size"] ** 2))[r["cell"]] = r["value"]
    # Largest variance first; the number of components bounds this, not the number of vectors.
    turns = spark.sparkContext.broadcast({s: np.linalg.eigh(v.reshape(s, s))[1][:, ::-1].copy() for s, v in sums.items()})
    width = float(np.sqrt(max(2 - 2 * least, 0.0)) * (1 + 1e-9) + 1e-9)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.zeros((batch.num_rows, 3), np.int64)
            for size, (own, x) in _by_size(batch.column("embedding")):
                lead = unit(x) @ turns.value[size][:, :2]
                cell[own, 0] = size
                cell[own, 1 : 1 + lead.shape[1]] = np.floor(lead / width)
            yield pa.record_batch([*batch.columns, *(pa.array(cell[:, k].copy()) for k in range(3))], names=[*batch.schema.names, "size", "x", "y"])

    label_type = dict(classes.dtypes)["label"]
    placed = classes.drop("least").select("label", "embedding", "rep", "copies").mapInArrow(cells, f"label {label_type}, embedding array<double>, rep long, copies long, size long, x long, y long")
    placed = store(placed, "placed")
    cell = ["label", "size", "x", "y"]
    tiles = placed.groupBy(*cell).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    placed = placed.join(tiles, cell).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    tiles = placed.groupBy(*cell, "tile").agg(F.collect_list(F.struct("rep", "copies", "embedding")).alias("members"))
    tiles = store(tiles, "tiles")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                left = _tile(row.column("members"))
                right = _tile(row.column("other")) if "other" in row.schema.names else None
                got = tile_links(left, right, turns.value[left[2].shape[1]], least)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in got], names=["a", "b", "links"])

    within = tiles.select("members").mapInArrow(compare, "a long, b long, links long")
    around = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))))
    ahead = tiles.select("*", F.explode(around).alias("step")).select(
        "label", "size", (F.col("x") + F.col("step.dx")).alias("x"), (F.col("y") + F.col("step.dy")).alias("y"), "members",
        F.when((F.col("step.dx") == 0) & (F.col("step.dy") == 0), F.col("tile")).otherwise(-1).alias("after"))
    pairs = ahead.join(tiles.select(*cell, "tile", F.col("members").alias("other")), cell).where("tile > after").select("members", "other")
    links = store(within.union(pairs.mapInArrow(compare, "a long, b long, links long")), "links")

    found = store(components(links.select("a", "b")).withColumnRenamed("node", "rep"), "found")
    smallest = found.join(classes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("smallest"))
    found = found.join(smallest, "component")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    known = classes.join(found, "rep", "left").join(counts, "rep", "left").select(
        "label", "embedding", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    component = F.coalesce("component", "vec_id")
    good = rows.where(sound).join(known, ["label", "embedding"], "left")
    good = good.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
    bad = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return good.union(bad)


def _tile(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    members = column.flatten()
    ids, copies = (members.field(k).to_numpy() for k in (0, 1))
    return ids, copies, members.field(2).flatten().to_numpy().reshape(len(ids), -1)
