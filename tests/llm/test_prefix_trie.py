"""The trie of conversation prefixes against a dictionary of all prefixes."""

import collections
import hashlib
import random
import zlib

import pytest

from tidegate.llm import prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string, path string, shard int, ref long, h long, kind string"


def brute(rows):
    """All nodes, from (conv_id, turn, role, text); turns of one conversation must be distinct."""
    said = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            said[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in said.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        rebuilt[c] = (own.get(first, [])[:h], own[c][h:])
        rebuilt[c] = tuple(rebuilt[c][0] + rebuilt[c][1])
    members, ends = collections.defaultdict(set), collections.defaultdict(list)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return collections.Counter(
        (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p in members)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 1, 1, "clash") for r in rows], CONVERSATIONS)


def check(spark, rows, **options):
    got = prefix_trie.conversation_trie(table(spark, rows), **options)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == brute(rows)


def made(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 3 * n), n):
        same = rng.random() < 0.3  # a third are copies of one conversation
        for turn in range(4 if same else rng.randint(1, 9)):
            at = None if turn == 0 and rng.random() < 0.1 else turn
            text = f"hot {turn}" if same else rng.choice(["", None, "a", "漢字\U0001F600", "b b", f"t{rng.random()}"])
            rows.append((c, at, "user" if same else rng.choice(["user", "assistant", None, ""]), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_nodes_are_those_of_all_prefixes(spark, seed):
    check(spark, made(seed, 500))


def test_many_shards_and_few_waiting_rows(spark):
    check(spark, made(7, 600), shard_turns=40, waiting=5)


def test_one_group_of_copies_and_one_long_conversation(spark):
    rows = [(c, t, "user", "same") for c in range(900) for t in range(8)]
    rows += [(c, t, "user", "x" * (t % 7)) for c in (5000, 5001, 5100) for t in range(700)]
    check(spark, rows, shard_turns=200, waiting=20)


def test_nulls_empty_and_a_conversation_without_turns_left(spark):
    check(spark, [(None, 0, "user", "lost"), (1, None, None, None), (2, 0, "", ""), (100, 0, "user", "x"), (101, 1, "a", "b")])
    check(spark, [(c, 0, "user", "only") for c in range(101, 130)])  # no conversation 100: some have no turn left
    assert prefix_trie.conversation_trie(table(spark, [])).count() == 0


def test_repeated_rows_all_stay(spark):
    rows = [(100, 0, "user", "x")] * 7
    depths = sorted(r["depth"] for r in prefix_trie.conversation_trie(table(spark, rows)).collect())
    assert depths == list(range(8))


def test_role_and_text_do_not_run_together(spark):
    rows = [(c, 0, *said) for c, said in ((300, ("ab", "c")), (400, ("a", "bc")), (500, ("1:a", "x")), (600, ("1:", "ax")))]
    check(spark, rows)
