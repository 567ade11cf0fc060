"""The prefix trie against nested dictionaries."""

from __future__ import annotations

from collections import defaultdict
import hashlib
import random
import zlib

import pytest

from mdlake.llm import prefix_trie
from mdlake.operators import slices

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node string, n string, parent string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def turns_by_hand(rows):
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            conversations[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t[2] for t in sorted(turns)] for c, turns in conversations.items()}


def rebuilt_by_hand(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def trie_by_hand(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children.get(path, 0), leaves[path], saved[path],
         hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest())
        for path, who in members.items()
    )


def nodes_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_rows(n, seed):
    """Conversations that share openings, with repeated and null turns, null roles and texts, and copies."""
    random.seed(seed)
    rows = []
    for c in random.sample(range(3 * n), n):
        length = random.choice([1, 2, 3, 5, 9])
        turns = [(i, random.choice(["user", "assistant", None]), random.choice(["a", "b", "", None, "ü😀"])) for i in range(length)]
        if random.random() < 0.2:
            turns.append(random.choice(turns))
        if random.random() < 0.2:
            turns.append((None, "system", "first"))
        rows += [(c, *t) for t in turns]
    return rows + [(None, 0, "user", "nobody's")]


@pytest.mark.parametrize("local", [1, 16, 10**9])
@pytest.mark.parametrize("openings", [True, False])
def test_nodes_equal_brute_force(spark, local, openings):
    rows = random_rows(120, local % 7 + openings)
    own = turns_by_hand(rows)
    want = trie_by_hand(rebuilt_by_hand(own) if openings else own)
    got = prefix_trie.prefix_trie(frame(spark, rows), openings, local)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert nodes_of(got) == want


def test_one_conversation_with_a_third_of_all_rows_and_branches_all_along(spark):
    random.seed(2)
    chain = [(i, "user", f"t{i}") for i in range(300)]
    rows = [(1, *t) for t in chain]
    for c in range(2, 40):
        k = random.randrange(1, 300)
        rows += [(c, *t) for t in chain[:k][-15:]] if c % 2 else [(c, *t) for t in [*chain[: k % 40], (k, "user", f"own{c}")]]
    got = prefix_trie.prefix_trie(frame(spark, rows), local=4)
    assert nodes_of(got) == trie_by_hand(turns_by_hand(rows))


def test_copies_of_one_conversation_end_at_one_node(spark):
    rows = [(c, t, "user", "same" * t) for c in range(500) for t in range(2)] + [(900 + c, 0, "user", f"o{c}") for c in range(30)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ends of one node in several slices
    try:
        got = prefix_trie.prefix_trie(frame(spark, rows), local=8)
        assert nodes_of(got) == trie_by_hand(turns_by_hand(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_turnless_conversations_belong_to_the_root(spark):
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)  # loses its turns; there is no opening
    rows = [(alone, 0, "user", "x"), (700, 0, "user", "y")]
    got = prefix_trie.prefix_trie(frame(spark, rows), openings=True)
    want = trie_by_hand(rebuilt_by_hand(turns_by_hand(rows)))
    assert nodes_of(got) == want and want[0][3] == 2


def test_empty_table(spark):
    for rows in ([], [(None, 1, "user", "x")]):
        assert prefix_trie.prefix_trie(frame(spark, rows), openings=True).collect() == []


def test_rounds_are_logarithmic_in_a_chain(spark, monkeypatch):
    rounds = []
    divide = prefix_trie.divide
    monkeypatch.setattr(prefix_trie, "divide", lambda *a: rounds.append(1) or divide(*a))
    rows = [(1, t, "user", str(t)) for t in range(200)]
    got = prefix_trie.prefix_trie(frame(spark, rows), local=1)
    assert nodes_of(got) == trie_by_hand(turns_by_hand(rows))
    assert len(rounds) <= 9
