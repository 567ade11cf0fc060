"""BPE, line dedup, substring dedup, sharding and conversations against brute force on small tables."""

from __future__ import annotations

from collections import Counter, defaultdict
import math
import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
import pytest
import regex
import xxhash

from mdlake.llm import bpe, conversations, line_dedup, sharding, substring
from mdlake.operators import slices

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "a", "é\x1cü x y", "ab\tcd\x0bef", "日本語 テキスト\n漢字"]


def no_clash(df, *names):
    assert len(set(df.columns)) == len(df.columns)
    assert set(names) <= set(df.columns)


# --- BPE ----------------------------------------------------------------------------------------


def merge_by_hand(ranks, piece: bytes) -> list[int]:
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], math.inf))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


def test_bpe_equals_merging_by_hand(make_docs):
    texts = ODD + ["It's we'll THE'LL don't  two  spaces \n x", "12345 67,89!! $$$ <|endoftext|>", "ñandú crème—brûlée 👩‍👩‍👧 x"]
    encoder = bpe.encoding(bpe.read_ranks(RANKS), PATTERN)
    ranks = {encoder.decode_single_token_bytes(i): i for i in range(50256)}
    docs = make_docs(list(enumerate(texts)), extra=("ids", "decoded"))
    out = bpe.round_trip(docs, RANKS, PATTERN)
    no_clash(out, "ids", "decoded", "lang")
    for row in out.collect():
        text = texts[row["doc_id"]] or ""
        want = [i for piece in regex.findall(PATTERN, text) for i in merge_by_hand(ranks, piece.encode())]
        assert row["ids"] == want and bytes(row["decoded"]) == text.encode()
    two = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    assert two.select("doc_id", "ids", "decoded").collect() == out.select("doc_id", "ids", "decoded").collect()


def test_bpe_long_text_is_cut_at_safe_places(make_docs):
    random.seed(1)
    alphabet = ["the", "ab", "'s", "'ll", " ", "  ", "\n", "12", "!!", "é", "ß", ".", "-", "\t", "x1y2", " ", "\x1c", "中"]
    text = "".join(random.choice(alphabet) for _ in range(40_000))
    encoder = bpe.encoding(bpe.read_ranks(RANKS), PATTERN)
    whole = encoder.encode_ordinary(text)
    for limit in (50, 997, 1 << 16):
        assert "".join(bpe.pieces(text, limit)) == text
        assert bpe.token_ids(encoder, text, limit).tolist() == whole
    solid = "a" * 300_000
    row = bpe.round_trip(make_docs([(1, solid), (1, solid)]), RANKS, PATTERN).select("decoded").collect()
    assert [bytes(r[0]) for r in row] == [solid.encode()] * 2


def test_bpe_decodes_ids_that_are_not_utf8(spark):
    encoder = bpe.encoding(bpe.read_ranks(RANKS), PATTERN)
    ids = encoder.encode_ordinary("👩")[:1]
    out = bpe.decode(spark.createDataFrame([(ids,), ([],), (None,)], "ids array<int>"), RANKS, PATTERN)
    assert [bytes(r["decoded"]) for r in out.collect()] == [encoder.decode_bytes(ids), b"", b""]


def test_bpe_empty_table(make_docs):
    assert bpe.round_trip(make_docs([]), RANKS, PATTERN).count() == 0


# --- line dedup ---------------------------------------------------------------------------------


def lines_by_hand(pairs, min_length=10, min_docs=2):
    key = lambda s: re.sub(r"[A-Z]", lambda m: m[0].lower(), s.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in pairs:
        for s in (text or "").split("\n"):
            if i is not None and len(key(s)) >= min_length:
                holders[key(s)].add(i)
    out = []
    for i, text in pairs:
        every = (text or "").split("\n")
        kept = [s for s in every if i is None or len(holders[key(s)]) < min_docs or i <= min(holders[key(s)])]
        out.append((i, "\n".join(kept), len(every), len(every) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines_equal_brute_force(make_docs, min_docs):
    random.seed(2)
    pool = ["Shared line one", " shared LINE one\t", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü ÄÖÜ ÄÖÜ", "short", "", "ten chars!", "日本語日本語日本語日", "unique"]
    pairs = [(i, "\n".join(random.choice(pool) + random.choice(["", "", str(i)]) for _ in range(8))) for i in range(40)]
    pairs += [(3, "Shared line one\nShared line one"), (3, "Shared line one"), (None, "Shared line one"), (90, None), (91, "")]
    pairs += [(92, "Shared line one\n" * 20_000)]
    out = line_dedup.dedup_lines(make_docs(pairs, extra=("n_lines", "id", "first")), min_docs=min_docs)
    no_clash(out, "lang", "n_lines", "id", "first")
    assert Counter(map(tuple, out.select("doc_id", "text", "n_lines", "n_dropped").collect())) == lines_by_hand(pairs, min_docs=min_docs)


def test_lines_empty_table(make_docs):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0


# --- substring dedup ----------------------------------------------------------------------------


def repeats_by_hand(pairs, k):
    first = {}
    for i, text in pairs:
        w = WORD.findall(text or "")
        for s in range(len(w) - k + 1):
            if i is not None:
                first[tuple(w[s : s + k])] = min(i, first.get(tuple(w[s : s + k]), i))
    out = []
    for i, text in pairs:
        w = WORD.findall(text or "")
        gone = set()
        for s in range(len(w) - k + 1):
            if i is not None and first[tuple(w[s : s + k])] < i:
                gone.update(range(s, s + k))
        out.append((i, " ".join(x for p, x in enumerate(w) if p not in gone), len(w), len(gone)))
    return Counter(out)


@pytest.mark.parametrize("batch, split", [(3, 0), (10_000, 0), (3, 2), (10_000, 1)])
def test_substrings_equal_brute_force(spark, make_docs, monkeypatch, batch, split):
    if split:  # every cell or every second one is split, and there are many buckets
        monkeypatch.setattr(substring, "large_cells", lambda *args: np.arange(args[-1]) % split == 0)
        monkeypatch.setattr(substring, "BUCKET_BYTES", 40_000)
    random.seed(3)
    words = [f"w{i}" for i in range(200)] + ["é\x1cb", "日本"]
    text = lambda n, of=words: " ".join(random.choice(of) for _ in range(n))
    passages = [text(n) for n in (13, 14, 40, 90)] + ["a a a " * 12, "a b " * 30]
    pairs = [(i, text(random.randint(0, 30)) + "\n" + random.choice(passages) + "\t" + text(random.randint(0, 20))) for i in range(60)]
    pairs += [(100 + i, random.choice(pairs)[1]) for i in range(10)] + [pairs[5], pairs[5], (7, passages[3]), (None, passages[3])]
    pairs += [(200 + i, t) for i, t in enumerate(ODD)] + [(300, text(20_000, words[:3])), (301, passages[2] + " " + text(5_000))]
    random.shuffle(pairs)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = substring.remove_repeats(make_docs(pairs, extra=("doc", "start", "digest", "n_words", "src")).repartition(3))
        no_clash(out, "lang", "doc", "start", "src")
        got = Counter(map(tuple, out.select("doc_id", "text", "n_words", "n_removed").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == repeats_by_hand(pairs, 13)


@pytest.mark.parametrize("tasks", [1, 4, 100])
def test_large_cells_are_found(make_docs, tasks):
    random.seed(4)
    common = "at the end of"
    texts = [" ".join([*(f"w{i}.{j}" for j in range(random.randint(9, 12))), common]) for i in range(400)]
    docs = make_docs(list(enumerate(texts)) + [(None, common * 20), (900, "a b"), (901, None)]).repartition(tasks)
    edges = Counter()
    for text in texts:
        minimiser, first, every = substring.pieces(text.encode().split(), 13)
        for m, n in zip(minimiser, np.diff(first, append=len(every))):
            edges[int(m) % 64] += int(n)
    total = sum(edges.values())
    for share in (0.02, 0.03, 0.5):
        large = substring.large_cells(docs, "doc_id", "text", 13, share, 64)
        assert all(large[i] for i, n in edges.items() if n >= share * total)
        assert not any(large[i] for i in range(64) if edges[i] < share / 2 * total)
    assert not substring.large_cells(make_docs([]), "doc_id", "text", 13, 0.1, 64).any()


def test_spans_are_compact_and_name_their_source(make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = make_docs([(1, "x y " + passage), (2, "u " + passage + " v"), (3, passage)])
    spans = substring.repeated_spans(docs)
    assert sorted(map(tuple, spans.select("doc", "start", "len", "src", "src_start").collect())) == [(2, 1, 60, 1, 2), (3, 0, 60, 1, 2)]


def test_wrong_spans_are_refuted(spark, make_docs):
    docs = make_docs([(1, " ".join(map(str, range(50)))), (2, " ".join(map(str, range(50))))])
    spans = spark.createDataFrame([(2, 0, 20, 1, 0), (2, 5, 20, 1, 6)], "doc long, start long, len long, src long, src_start long")
    assert [r["start"] for r in substring.verified(docs, spans, "doc_id", "text").collect()] == [0]


def test_substrings_empty_table(make_docs):
    assert substring.remove_repeats(make_docs([])).count() == 0


# --- sharding -----------------------------------------------------------------------------------


def shard_by_hand(tree, key):
    weight = lambda n: sum(map(weight, n.values())) if isinstance(n, dict) else n

    def draw(name, w):
        u = ((xxhash.xxh64_intdigest(f"{name}:{key}".encode(), 42) >> 11) + 0.5) * 2.0**-53
        return -math.log(u) / w

    while True:
        name = min(tree, key=lambda n: draw(n, weight(tree[n])))
        if not isinstance(tree[name], dict):
            return name
        tree = tree[name]


def test_shards_equal_brute_force_and_slots_have_no_gaps(make_docs):
    pairs = [(i, "t" * (i % 5)) for i in range(3000)] + [(None, None), (5, "again"), (5, "again")]
    tree = sharding.even_tree()
    rows = sharding.assign(make_docs(pairs).repartition(5), tree, grown_by=16)
    no_clash(rows, "shard", "slot", "grown_shard", "lang")
    rows = rows.select("doc_id", "shard", "slot", "grown_shard").collect()
    for r in rows:
        key = "" if r["doc_id"] is None else r["doc_id"]
        assert r["shard"] == shard_by_hand(tree, key)
        assert r["grown_shard"] == shard_by_hand(sharding.grown(tree, 16), key)
        assert r["grown_shard"] in (r["shard"], 16)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
    moved = sum(r["grown_shard"] == 16 for r in rows) / len(rows)
    assert 0.03 < moved < 0.09


def test_changed_weight_moves_rows_only_through_its_subtree(make_docs):
    docs = make_docs([(i, "") for i in range(4000)])
    before, after = sharding.even_tree(), sharding.even_tree()
    after["region0"]["rack0.1"][5] = 3.0
    both = docs.select(
        sharding.shard_of(before, F.col("doc_id")).alias("a"), sharding.shard_of(after, F.col("doc_id")).alias("b")
    ).collect()
    moved = [(r["a"], r["b"]) for r in both if r["a"] != r["b"]]
    inside = {4, 5, 6, 7}
    assert moved and all(b in inside or (a not in range(8) and b in range(8)) for a, b in moved)
    share = Counter(r["b"] for r in both)
    assert share[5] > 2 * share[6]


def test_sharding_empty_table(make_docs):
    assert sharding.assign(make_docs([]), sharding.even_tree(), grown_by=16).count() == 0


def test_shard_files(make_docs, tmp_path, spark):
    rows = sharding.assign(make_docs([(i, "t") for i in range(200)], extra=()), sharding.even_tree())
    sharding.write_shards(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 16


@pytest.mark.parametrize("looked_up", [1 << 20, 200])
def test_real_repeats_behind_clashing_edges_are_found(spark, make_docs, monkeypatch, looked_up):
    """Edges told apart by one byte only: most spans name a wrong source, and are looked up again."""
    monkeypatch.setattr(substring, "EDGE_BYTES", 1)
    monkeypatch.setattr(substring, "LOOKED_UP", looked_up)
    monkeypatch.setattr(substring, "PLACES", 3)
    random.seed(21)
    common = [f"c{i}" for i in range(40)]
    passages = [[f"p{i}x{k}" for k in range(15)] for i in range(60)]
    pairs = []
    for i in range(120):
        own = [f"o{random.randrange(50_000)}" for _ in range(20)]
        pairs.append((i, " ".join(own[:10] + common + passages[i % 60] + own[10:])))
    pairs += [(None, pairs[0][1]), (3, pairs[70][1]), (500, None), (501, "")]
    refused = []
    monkeypatch.setattr(substring, "exact_sources", lambda *a, f=substring.exact_sources: refused.append(a[1].count()) or f(*a))
    out = substring.remove_repeats(make_docs(pairs))
    got = Counter((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in out.collect())
    assert refused and refused[0] > 20
    assert got == repeats_by_hand(pairs, 13)


# --- conversations ------------------------------------------------------------------------------


def test_only_maximal_conversations_remain(spark):
    turns = {
        1: [("user", "hi"), ("assistant", "hello")],
        2: [("user", "hi"), ("assistant", "hello"), ("user", "more")],
        3: [("user", "hi"), ("assistant", "hello"), ("user", "more")],
        4: [("user", "hi"), ("user", "hello")],
        5: [("user", "hi")],
        6: [(None, None)],
        7: [("user", "x" * 100_000)],
        8: [("assistant", "hello"), ("user", "hi")],
    }
    rows = [(c, 3 * n, r, t, "extra") for c, ts in turns.items() for n, (r, t) in enumerate(ts)]
    rows += [(2, 0, "user", "hi", "extra"), (None, 0, "user", "hi", "lost"), (9, None, "user", "hi", ""), (9, 1, "assistant", "hello", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, h1 string")
    out = {r["conv_id"]: (r["n_turns"], r["text"]) for r in conversations.collapse_snapshots(df).collect()}
    assert set(out) == {2, 4, 6, 7, 8}
    assert out[2] == (3, "<|user|>\nhi<|end|>\n<|assistant|>\nhello<|end|>\n<|user|>\nmore<|end|>\n")
    assert out[6] == (1, "<||>\n<|end|>\n")


def test_conversations_equal_brute_force(spark):
    random.seed(4)
    convs = {c: [random.choice("ab") for _ in range(random.randint(1, 5))] for c in range(60)}
    df = spark.createDataFrame([(c, n, "r", t) for c, ts in convs.items() for n, t in enumerate(ts)], "conv_id long, turn long, role string, text string")
    want = {
        c
        for c, ts in convs.items()
        if not any((len(o) > len(ts) and o[: len(ts)] == ts) or (o == ts and d < c) for d, o in convs.items())
    }
    assert {r["conv_id"] for r in conversations.collapse_snapshots(df).collect()} == want


def test_conversations_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.collapse_snapshots(empty).count() == 0




def test_a_conversation_with_a_third_of_all_rows_spreads_over_tasks(spark):
    rows = [(1, i, "user", f"hot {i}") for i in range(600)] + [(10 + c, i, "user", f"{c} {i}") for c in range(300) for i in range(4)]
    rows += [(5, i, "user", f"hot {i}") for i in range(200)]  # a snapshot of the hot one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small shuffles are cut like large ones
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        ordered = conversations.ordered_turns(df)
        assert ordered.where("conv_id = 1").select(slices.SLICE).distinct().count() > 1
        out = {r["conv_id"]: (r["n_turns"], r["text"]) for r in conversations.collapse_snapshots(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(out) == {1, *range(10, 310)}
    assert out[1] == (600, "".join(f"<|user|>\nhot {i}<|end|>\n" for i in range(600)))
