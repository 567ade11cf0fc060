"""SimHash, components, decontamination, the pipeline and the registered queries."""

from __future__ import annotations

from collections import defaultdict
import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from mdlake.llm import components, decontaminate, registry, simhash
from tests.compare import compare, duck

ODD = [None, "", " ", "a", "A", "日本語 É é", "word " * 60_000]


# --- components ---------------------------------------------------------------------------------


def roots_by_hand(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    random.seed(8)
    order = random.sample(range(200), 200)
    links = {
        "chain": list(zip(order, order[1:])),
        "star": [(order[0], x) for x in order[1:]],
        "random": [(random.randrange(300), random.randrange(300)) for _ in range(150)],
        "none": [],
    }[shape]
    df = spark.createDataFrame([*links, (None, 3), (4, 4)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.connected(df).collect()}
    assert got == roots_by_hand([(a, b) for a, b in links if a != b])


# --- SimHash ------------------------------------------------------------------------------------


def fingerprint_by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force():
    random.seed(9)
    for text in ODD[:6] + [" ".join(random.choice("ABCdeé") for _ in range(n)) for n in range(1, 60)]:
        assert simhash.fingerprint(text) % 2**64 == fingerprint_by_hand(text)


@pytest.mark.parametrize("tile", [7, 32_768])
def test_tiled_links_join_all_within_radius(spark, tile):
    random.seed(10)
    seeds = [random.getrandbits(64) for _ in range(12)] + [0, 2**64 - 1]
    values = set(seeds)
    for s in seeds:
        for _ in range(25):
            v = s
            for _ in range(random.randint(1, 6)):
                v ^= 1 << random.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    classes = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    links = simhash.tile_links(classes, tile=tile)
    want = [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    got = {r["node"]: r["root"] for r in components.connected(links).collect()}
    assert got == roots_by_hand(want)
    assert all((values[r["a"]] ^ values[r["b"]]).bit_count() >= 1 for r in links.collect())


def test_dense_group_gives_a_forest_not_all_pairs():
    values = np.array([1 << i for i in range(64)], np.uint64)  # all pairs differ in two bits
    assert len(list(simhash.forest(values, None, 4))) == 63


def test_near_duplicates_edge_cases(make_docs):
    pairs = [*enumerate(ODD), (9, "same text here " * 9), (8, "same text here " * 9), (8, "same text here " * 9), (None, "a")]
    out = simhash.near_duplicates(make_docs(pairs, extra=("fp", "component_id", "id", "p", "t")))
    rows = defaultdict(set)
    for r in out.collect():
        rows[r["doc_id"]].add(r["component_id"])
    assert rows[0] == rows[1] == rows[2] == {0} and rows[3] == rows[4] == {3}
    assert rows[9] == rows[8] == {8} and rows[None] == {None} and out.count() == len(pairs)
    assert simhash.near_duplicates(make_docs([])).count() == 0


# --- decontamination ----------------------------------------------------------------------------


def words_by_hand(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def hits_by_hand(pairs, items):
    out = []
    for i, text in pairs:
        w = words_by_hand(text)
        covered, found = set(), set()
        for item, passage in items:
            p = words_by_hand(passage)
            if item is None or not p:
                continue
            k = min(10, len(p))
            windows = {tuple(p[s : s + k]) for s in range(len(p) - k + 1)}
            for s in range(len(w) - k + 1):
                if tuple(w[s : s + k]) in windows:
                    covered.update(range(s, s + k))
                    found.add(str(item))
        out.append((i, len(w), len(covered), sorted(found)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark, make_docs):
    random.seed(11)
    vocabulary = ["the", "of", "a", "b2", "Éa", "éa", "c"] + [f"w{i}" for i in range(40)]
    text = lambda n, of=vocabulary: random.choice([" ", ", ", "-"]).join(random.choice(of) for _ in range(n))
    items = [(i, text(random.randint(1, 40))) for i in range(15)] + [(3, text(12)), (20, None), (21, "!!"), (None, "the of a"), (100, "a " * 25)]
    items += [(30, "the of a " * 6), (31, "zz zz")]
    pairs = []
    for i in range(60):
        p = words_by_hand(random.choice(items)[1])
        a = random.randint(0, max(0, len(p) - 3))
        pairs.append((i, text(random.randint(0, 15)) + " " + " ".join(p[a : a + random.randint(1, 30)]).upper() + " " + text(random.randint(0, 15))))
    pairs += [*((200 + i, t) for i, t in enumerate(ODD)), pairs[3], (3, "other"), (None, items[0][1]), (300, "the of a b2 c " * 3000)]
    benchmark = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, term string")
    out = decontaminate.contamination(make_docs(pairs, extra=("row", "pos", "n_hit", "term", "words")), benchmark)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in out.collect()]
    assert sorted(got, key=str) == hits_by_hand(pairs, items)
    assert out.where("contaminated != (n_hit > 0)").count() == 0


def test_proximity_finds_near_terms_in_any_order(spark, make_docs):
    docs = make_docs([(1, "x y alpha z beta q gamma r"), (2, "gamma beta alpha"), (3, "alpha " + "n " * 40 + "beta gamma"), (4, "alpha beta")])
    benchmark = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build(docs, benchmark)
    assert sorted(r["doc_id"] for r in decontaminate.proximity(index, slop=3, size=3).collect()) == [1, 2]
    assert decontaminate.phrases(index).count() == 0


def test_contamination_of_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_words"] for r in decontaminate.contamination(make_docs([(1, "a b")]), none).collect()] == [2]
    assert decontaminate.contamination(make_docs([]), none).count() == 0


# --- queries ------------------------------------------------------------------------------------

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, name):
    n, problem = compare(entry.queries()[name](spark, SMALL), duck(SMALL), entry.oracle_sql()[name])
    assert not problem and n > 0


def test_decontamination_plan_is_native(spark):
    plan = registry.queries()["op5_positional_decontamination"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles()) - {"op12_bit_sliced_whitening"}))
def test_other_queries_return_every_row(spark, name):
    rows = registry.queries()[name](spark, SMALL).collect()
    assert 0 < len(rows) <= 200 and (name == "pipeline" or len(rows) == 200)


def test_whitening_returns_every_vector_and_component(spark):
    rows = registry.queries()["op12_bit_sliced_whitening"](spark, SMALL).select("vec_id", "component").collect()
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
    assert len(set(rows)) == len(rows) == 16 * vectors
