"""The pipeline against a brute-force version, stage by stage."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from mdlake.llm import quality_model
from tests.llm.test_search import fingerprint_by_hand, hits_by_hand, roots_by_hand
from tests.llm.test_text_operators import lines_by_hand

SMALL = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    judged = quality_model.classify(documents, labels).collect()  # held-out accuracy is tested elsewhere
    pairs = [(r["doc_id"], r["text"]) for r in judged if r["score"] >= 0.3]
    pairs = [(i, t) for i, t, _, _ in lines_by_hand(pairs)]
    prints = {i: fingerprint_by_hand(t) for i, t in pairs}
    ids = sorted(prints)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = roots_by_hand(links)
    pairs = [(i, t) for i, t in pairs if roots.get(i, i) == i]
    clean = {i for i, _, hit, _ in hits_by_hand(pairs, benchmark) if not hit}
    with open(public_tokenizers.path(corpus_pipeline.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: encoder.encode_ordinary(t) for i, t in pairs if i in clean}
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == want


def test_stages_take_effect_and_keep_the_columns(spark, make_docs, tmp_path):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    prose = "the quick brown fox jumps over a lazy dog near some old river bank every single day"
    pairs = [(1, prose), (2, prose), (3, "A line that is shared.\nown words here"), (4, "a line THAT is shared.\nother things said"),
             (5, "so " + passage), (None, "oh " + passage), (6, None), (7, "")]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs(pairs)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs = docs.cache()
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert kept[1] == prose and kept[3] == "A line that is shared.\nown words here" and kept[4] == "other things said"
    assert 2 not in kept or kept[2] != prose  # its only line went, or the whole document as a copy
    assert 5 not in kept and None not in kept


def test_near_duplicates_keep_one_of_each_group_though_an_id_has_two_texts(spark, make_docs, tmp_path):
    first, second = "one two three four five six seven", "red green blue black white pink grey brown"
    docs = make_docs([(1, first), (2, first), (2, second), (3, second), (3, second)])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, first), (2, first), (2, second)]


def test_near_duplicates_are_linked_by_four_bits(spark, make_docs, tmp_path):
    random.seed(12)
    pairs = []
    for base in range(0, 300, 10):
        source = [f"w{random.randrange(10_000)}" for _ in range(150)]
        for i in range(10):
            changed = list(source)
            for at in random.sample(range(150), random.randrange(9)):
                changed[at] = f"x{random.randrange(10_000)}"
            pairs.append((base + i, " ".join(changed)))
    pairs += [(900, None), (901, ""), (902, "short text"), (903, "Short  TEXT")]
    prints = {i: fingerprint_by_hand(t) for i, t in pairs}
    distances = {(a, b): (prints[a] ^ prints[b]).bit_count() for a in prints for b in prints if b < a}
    links = [pair for pair, d in distances.items() if d <= 4]
    assert any(0 < distances[pair] for pair in links) and any(4 < d <= 12 for d in distances.values())
    roots = roots_by_hand(links)
    kept = corpus_pipeline.drop_near_duplicates(spark, make_docs(pairs), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == {i for i in prints if roots.get(i, i) == i}


def test_stages_on_empty_tables(spark, make_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0
