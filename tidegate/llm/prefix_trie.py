"""The trie of conversation prefixes, by a skeleton of splitters.

A conversation is a path: one 16-byte digest of (role, text) per turn, in the order of turns. Paths are cut into sorted
ranges ("shards") by splitters, which are paths of a sample together with their conv_id, so that a group of equal
conversations is split as well. A trie node whose conversations lie in two shards is a prefix of the splitter between
them. So the trie of the splitters' paths, the skeleton, is broadcast; each shard reads its sorted rows once and
finishes every node outside of the skeleton by itself, and for skeleton nodes gives partial aggregates, which are summed
per node. What is broadcast has at most ``shards`` paths.

Within a shard only the nodes on the way to the present row are open. Their children wait for the smallest member of
their parent; more than ``waiting`` of them are written without it and joined to it afterwards, so memory is bounded by
one path and that number. The ids that end at a node are hashed as they come; for skeleton nodes they come from several
shards, as blocks of joined ids that are hashed in order without being held together.

Null roles and texts are empty; rows without conv_id belong to no conversation and are left out; a null turn comes before
all others. Rows with one conv_id and turn all stay, ordered by a digest of role and text. An empty table has no nodes.
Other columns are left out. One conversation is one row here, with 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.shared import store

DIGEST = 16
#: Rebuilding: the first turns of the conversation that begins a block of so many ids, at most GRAFT - 1 of them.
BLOCK = 100
GRAFT = 6
SHARD_TURNS = 1_000_000
MOST_SHARDS = 8192
SAMPLE_PER_SHARD = 16
WAITING = 200_000
ENDS_PER_BLOCK = 4096
ROWS_OUT = 20_000

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_RAW = pa.schema([("kind", pa.string()), ("ref", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("size", pa.int64()), ("place", pa.int64()), ("text", pa.string())])
_RAW_DDL = "kind string, ref long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, place long, text string"


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): per conversation its turns' digests in a row and their code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull(), F.col("turn"), F.substring(F.sha2(said, 256), 1, 2 * DIGEST).alias("digest"), F.char_length(text).alias("size")).alias("t"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.unhex(F.array_join("t.digest", "")).alias("path"), F.col("t.size").alias("sizes"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the first h turns of the block's first conversation, then the own turns after the first h.

    h is the unsigned crc32 of the decimal conv_id modulo ``GRAFT``.
    """
    own = paths(conversations).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % GRAFT).cast("int"))
    firsts = paths(conversations.where(F.col("conv_id") % BLOCK == 0)).select(
        F.col("conv_id").alias("first_id"), F.substring("path", 1, DIGEST * (GRAFT - 1)).alias("first_path"), F.slice("sizes", 1, GRAFT - 1).alias("first_sizes"))
    both = own.withColumn("first_id", F.col("conv_id") - F.col("conv_id") % BLOCK).join(firsts, "first_id", "left")
    return both.select(
        "conv_id",
        F.expr(f"concat(coalesce(substring(first_path, 1, {DIGEST} * h), X''), substring(path, {DIGEST} * h + 1))").alias("path"),
        F.expr("concat(coalesce(slice(first_sizes, 1, h), cast(array() as array<int>)), slice(sizes, h + 1, greatest(size(sizes), 1)))").alias("sizes"),
    )


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, and parents have smaller numbers than their children."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.children: list[dict[bytes, int]] = [{}]
        self.parent, self.depth = [-1], [0]
        for path, _ in splitters:
            node = 0
            for i in range(0, len(path), DIGEST):
                turn = path[i : i + DIGEST]
                found = self.children[node].get(turn)
                if found is None:
                    found = self.children[node][turn] = len(self.parent)
                    self.children.append({})
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = found


def choose_splitters(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> list[tuple[bytes, int]]:
    """Sorted (path, conv_id) that cut the rows into about equal shards; the sample is picked by a hash of conv_id."""
    n, turns = rows.agg(F.count("*"), F.sum(F.size("sizes").cast("long"))).first()
    shards = min(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((turns or 0) / shard_turns)), MOST_SHARDS)
    one_in = max(1, n // (SAMPLE_PER_SHARD * shards))
    sample = sorted((bytes(r[0]), r[1]) for r in rows.where(F.pmod(F.xxhash64("conv_id"), F.lit(one_in)) == 0).select("path", "conv_id").collect())
    return [sample[len(sample) * i // shards] for i in range(1, shards)] if len(sample) >= shards else sample[1:]


def _with_shard(splitters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(splitters.value, k) for k in keys], pa.int32())
            yield pa.record_batch([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    return run


class _Node:
    __slots__ = ("depth", "ends", "kids", "least", "leaves", "n", "place", "ref", "saved", "size", "skeleton", "waiting")

    def __init__(self, depth: int, size: int, skeleton: int):
        self.depth, self.size, self.skeleton = depth, size, skeleton
        self.n = self.kids = self.leaves = self.saved = self.place = self.ref = 0
        self.least = self.ends = None
        self.waiting: list[list] = []


def _common(a: bytes, b: bytes) -> int:
    """Number of leading digests that two paths share."""
    most = min(len(a), len(b)) // DIGEST
    low = 0
    while low < most:
        middle = (low + most + 1) // 2
        if a[DIGEST * low : DIGEST * middle] == b[DIGEST * low : DIGEST * middle]:
            low = middle
        else:
            most = middle - 1
    return low


class _Shard:
    """One sorted shard: feeds rows in, keeps finished ones in ``out``."""

    def __init__(self, number: int, skeleton: Skeleton, waiting: int, out: list[list]):
        self.number, self.trie, self.most, self.out = number, skeleton, waiting, out
        self.before = b""
        self.open = [_Node(0, 0, 0)]
        self.n_waiting = self.n_refs = 0

    def row(self, path: bytes, conv_id: int, sizes: list[int]) -> None:
        same = _common(self.before, path)
        self.close_to(same)
        for d in range(same, len(path) // DIGEST):
            above = self.open[-1].skeleton
            skeleton = self.trie.children[above].get(path[DIGEST * d : DIGEST * (d + 1)], -1) if above >= 0 else -1
            self.open.append(_Node(d + 1, sizes[d], skeleton))
        self.before = path
        node = self.open[-1]
        node.n += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        self.ends(node, conv_id)

    def ends(self, node: _Node, conv_id: int) -> None:
        if node.skeleton >= 0:
            if node.ends is None:
                node.ends = []
            node.ends.append(str(conv_id))
            if len(node.ends) == ENDS_PER_BLOCK:
                self.block(node)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv_id).encode())
        else:
            node.ends.update(b",%d" % conv_id)

    def block(self, node: _Node) -> None:
        self.out.append(["ends", node.skeleton, None, None, None, None, None, None, None, None, (self.number << 32) + node.place, ",".join(node.ends)])
        node.place, node.ends = node.place + 1, []

    def close_to(self, depth: int) -> None:
        while len(self.open) - 1 > depth:
            node = self.open.pop()
            self.close(node, self.open[-1])

    def close(self, node: _Node, above: _Node | None) -> None:
        if node.skeleton >= 0:
            if node.ends:
                self.block(node)
            if node.n:
                self.out.append(["part", node.skeleton, node.least, node.depth, None, node.n, node.kids, node.leaves, node.saved, node.size, None, None])
        else:
            node.leaves += not node.kids
            node.saved += (node.n - 1) * node.size
            for row in node.waiting:
                row[4] = node.least
            self.out.extend(node.waiting)
            self.n_waiting -= len(node.waiting)
            if node.ref:
                self.out.append(["least", node.ref, node.least, *[None] * 9])
            above.kids += 1
            row = ["node", None, node.least, node.depth, None, node.n, node.kids, node.leaves, node.saved, None, None, (node.ends or hashlib.sha256()).hexdigest()]
            if above.skeleton >= 0:
                row[1] = above.skeleton
                self.out.append(row)
            else:
                above.waiting.append(row)
                self.n_waiting += 1
                if self.n_waiting > self.most:
                    self.let_go()
        if above is not None and node.n:
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
            above.leaves += node.leaves
            above.saved += node.saved

    def let_go(self) -> None:
        """Write waiting rows with a reference to their parent in place of its smallest member."""
        for node in self.open:
            if node.waiting:
                if not node.ref:
                    self.n_refs += 1
                    node.ref = (self.number + 1 << 40) + self.n_refs
                for row in node.waiting:
                    row[1] = node.ref
                self.out.extend(node.waiting)
                node.waiting = []
        self.n_waiting = 0

    def finish(self) -> None:
        self.close_to(0)
        self.close(self.open.pop(), None)


def _shards(splitters, waiting: int):
    def flush(out: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _RAW)], schema=_RAW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton = Skeleton(splitters.value)
        out: list[list] = []
        shard = None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "sizes"))
            for number, path, conv_id, sizes in zip(*columns):
                if shard is None or shard.number != number:
                    if shard:
                        shard.finish()
                    shard = _Shard(number, skeleton, waiting, out)
                shard.row(path, conv_id, sizes)
                if len(out) >= ROWS_OUT:
                    yield flush(out)
                    out.clear()
        if shard:
            shard.finish()
        if out:
            yield flush(out)

    return run


def _hash_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's blocks, which come in order."""
    node = digest = None
    for batch in batches:
        refs, hashes = [], []
        for ref, text in zip(batch.column("ref").to_pylist(), batch.column("text").to_pylist()):
            if ref == node:
                digest.update(b",")
            else:
                if node is not None:
                    refs.append(node)
                    hashes.append(digest.hexdigest())
                node, digest = ref, hashlib.sha256()
            digest.update(text.encode())
        yield pa.record_batch([pa.array(refs, pa.int64()), pa.array(hashes, pa.string())], names=["ref", "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([node], pa.int64()), pa.array([digest.hexdigest()])], names=["ref", "ends_sha256"])


def _skeleton_rows(spark: SparkSession, skeleton: Skeleton, parts: DataFrame) -> DataFrame:
    """Rows (ref, node columns) of the skeleton from its summed parts; as many as the splitters' paths have prefixes."""
    summed = parts.groupBy("ref").agg(F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("size"))
    found = {r[0]: list(r[1:]) for r in summed.collect()}
    below = {ref: [0, 0] for ref in found}  # leaves and saved tokens of skeleton nodes in the subtree
    rows = []
    for ref in sorted(found, reverse=True):
        least, n, kids, leaves, saved, size = found[ref]
        kids += sum(c in found for c in skeleton.children[ref].values())
        below[ref][0] += not kids
        below[ref][1] += (n - 1) * size
        above = skeleton.parent[ref]
        if ref:
            below[above][0] += below[ref][0]
            below[above][1] += below[ref][1]
        rows.append((ref, least, skeleton.depth[ref], found[above][0] if ref else None, n, kids, leaves + below[ref][0], saved + below[ref][1]))
    return spark.createDataFrame(rows, "ref long, " + NODE.rsplit(",", 1)[0])


def prefix_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS, waiting: int = WAITING) -> DataFrame:
    """Nodes of the trie of ``rows(conv_id, path, sizes)``, conv_id being distinct."""
    spark = rows.sparkSession
    rows = store(rows, "paths")
    splitters = choose_splitters(rows, shard_turns)
    skeleton, sent = Skeleton(splitters), spark.sparkContext.broadcast(splitters)
    dealt = rows.mapInArrow(_with_shard(sent), "conv_id long, path binary, sizes array<int>, shard int")
    dealt = dealt.repartitionByRange(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = store(dealt.mapInArrow(_shards(sent, waiting), _RAW_DDL), "trie")

    names = [c.split()[0] for c in NODE.split(", ")]
    inner = _skeleton_rows(spark, skeleton, found.where("kind = 'part'"))
    hashed = found.where("kind = 'ends'").select("ref", "place", "text").repartition("ref").sortWithinPartitions("ref", "place").mapInArrow(_hash_blocks, "ref long, ends_sha256 string")
    whole = inner.join(hashed, "ref", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))

    local = found.where("kind = 'node'").withColumn("ends_sha256", F.col("text"))
    far = local.where("ref is not null").drop("parent_conv_id")
    # The skeleton's size is bounded by the number of shards.
    under_skeleton = far.where(F.col("ref") < len(skeleton.parent)).join(F.broadcast(inner.select("ref", F.col("conv_id").alias("parent_conv_id"))), "ref")
    under_local = far.where(F.col("ref") >= 1 << 40).join(found.where("kind = 'least'").select("ref", F.col("conv_id").alias("parent_conv_id")), "ref")
    parts = [whole, local.where("ref is null"), under_skeleton, under_local]
    out = parts[0].select(*names)
    for part in parts[1:]:
        out = out.unionAll(part.select(*names))
    return out


def conversation_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, waiting: int = WAITING) -> DataFrame:
    """Per node of the rebuilt conversations' trie: smallest member, depth, parent's smallest member, members, children,
    childless nodes in the subtree, code points that a shared prefix saves, and the SHA-256 of the ids that end there."""
    return prefix_trie(rebuilt(conversations), shard_turns, waiting)
