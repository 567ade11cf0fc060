"""Quality classifier, rules, personal data: held-out accuracy and brute force on small tables."""

from __future__ import annotations

from collections import Counter
import random
import re
import zlib

import numpy as np
import pytest

from mdlake.llm import gbdt, pii, quality_model, quality_rules

ODD = [None, "", " \n ", "a", "日本語", "x" * 300_000, "a b c " * 30_000]


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


# --- trees --------------------------------------------------------------------------------------


def test_trees_learn_what_no_single_feature_shows():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(int)
    model = gbdt.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_array_traversal_equals_walking_each_tree():
    random_ = np.random.default_rng(1)
    x, y = random_.normal(size=(300, 3)), random_.integers(0, 2, 300)
    model = gbdt.fit(x, y, trees=7, depth=3)
    inner = model.feature.shape[1]
    for row, score in zip(x, model.score(x)):
        total = model.base
        for t in range(len(model.feature)):
            node = 0
            while node < inner:
                node = 2 * node + 1 + int(row[model.feature[t, node]] > model.threshold[t, node])
            total += model.leaf[t, node - inner]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-12


def test_histogram_fit_equals_trying_every_split():
    random_ = np.random.default_rng(8)
    x = np.round(random_.normal(size=(200, 4)), 1)
    y = (x[:, 2] + 0.3 * random_.normal(size=200) > 0.4).astype(int)
    model = gbdt.fit(x, y, trees=1, depth=2, rate=0.5, l2=1.0, least_hessian=2.0)
    p = (y.sum() + 0.5) / 201
    g, h = p - y, np.full(200, p * (1 - p))
    assert model.base == pytest.approx(np.log(p / (1 - p)))

    def best(rows):
        """(gain, feature, threshold) of the best split of some rows at the bins' edges."""
        def part(at):
            return g[at].sum() ** 2 / (h[at].sum() + 1.0)
        found = (1e-9, None, None)
        for f in range(4):
            for e in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])):
                left, right = rows & (x[:, f] <= e), rows & (x[:, f] > e)
                if min(h[left].sum(), h[right].sum()) >= 2.0:
                    found = max(found, (part(left) + part(right) - part(rows), f, e), key=lambda t: t[0])
        return found

    def gain(rows, f, e):
        left, right = rows & (x[:, f] <= e), rows & (x[:, f] > e)
        return sum(g[at].sum() ** 2 / (h[at].sum() + 1.0) for at in (left, right)) - g[rows].sum() ** 2 / (h[rows].sum() + 1.0)

    rows = {0: np.ones(200, bool)}
    for node in range(3):
        want = best(rows[node])
        f, e = model.feature[0, node], model.threshold[0, node]
        if want[1] is None:
            assert e == np.inf
        else:
            assert gain(rows[node], f, e) == pytest.approx(want[0])
        rows[2 * node + 1], rows[2 * node + 2] = rows[node] & (x[:, f] <= e), rows[node] & (x[:, f] > e)
    for leaf in range(4):
        at = rows[3 + leaf]
        assert model.leaf[0, leaf] == pytest.approx(-0.5 * g[at].sum() / (h[at].sum() + 1.0))


def statistics_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    raw = text.encode()
    n, total = max(len(raw), 1), max(len(w), 1)
    of = lambda chars: sum(c in chars for c in text) / n
    upper, lower = (sum(a <= c <= z for c in text) / n for a, z in ("AZ", "az"))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    pairs = list(zip(w, w[1:]))
    out = [upper, lower, sum("0" <= c <= "9" for c in text) / n, of("!"), of("?"), of("|"), of("#*$%&<>"), of(".,"), of("'\"()-:;/"), of("\n")]
    out += [sum(len(c.encode()) for c in text if ord(c) > 127) / n, upper / max(upper + lower, 1e-9), np.log1p(len(raw)), np.log1p(len(w))]
    out += [sum(len(x.encode()) for x in w) / total, len(set(w)) / total, max(Counter(w).values(), default=0) / total]
    out += [sum(a == b for a, b in pairs) / total, len(set(pairs)) / max(len(w) - 1, 1), sum(x[-1] in "!*#$%&|<>" for x in w) / total]
    out += [len(set(lines)) / max(len(lines), 1), len(w) / max(len(lines), 1), max((len(x.encode()) for x in lines), default=0) / n]
    return out + [sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in w) / total]


def test_classifier_statistics_equal_brute_force():
    random.seed(15)
    texts = [t for t in ODD if t is None or len(t) < 1000]
    texts += ["".join(random.choices(["A", "b ", "Cd ", "é", "\n", " ", "9", "!", "a|b ", "<#> ", "AB ", "\t", "x.y, "], k=random.randrange(60))) for _ in range(300)]
    for text in texts:
        assert np.allclose(quality_model.statistics(text), statistics_by_hand(text)), repr(text)


def test_classifier_on_held_out_rows(given):
    docs, labels = given
    rows = {r["doc_id"]: r for r in quality_model.classify(docs, labels).collect()}
    held = [(r["quality"], rows[r["doc_id"]]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert np.mean([r["predicted"] == q for q, r in held]) > 0.95


def test_held_out_labels_change_nothing(given, spark):
    docs, labels = given
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - quality, quality) quality")
    scores = lambda ls: sorted((r["doc_id"], r["score"]) for r in quality_model.classify(docs, ls).collect())
    assert scores(labels) == scores(flipped)


def test_classifier_edge_cases(make_docs, spark):
    docs = make_docs([*enumerate(ODD), (1, "again"), (None, "no id")], extra=("held_out", "predicted", "_quality", "quality"))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality_model.classify(docs, empty).collect()
    assert len(out) == len(ODD) + 2 and {r["score"] for r in out} == {0.5}
    labels = spark.createDataFrame([(1, None, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0), (77, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in quality_model.classify(docs, labels).collect())
    assert quality_model.classify(make_docs([]), labels).count() == 0


def test_samples_have_one_row_of_each_id(make_docs, spark, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    texts = {i: " ".join(f"w{i}x{k}" for k in range(60)) for i in ids}
    docs = make_docs([*texts.items(), *((ids[0], f"{texts[ids[0]]} {k}") for k in range(100))])
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int")
    x, y = quality_model.training_sample(docs, labels, len(ids))
    assert len(x) == len(ids) and y.tolist() == [n % 2 for n in range(len(ids))]
    monkeypatch.setattr(quality_rules, "fit_forest", lambda x, good: (x, good))
    x, good = quality_rules.fit(docs, labels, len(ids))
    assert len(x) == len(ids) and good.tolist() == [n % 2 == 1 for n in range(len(ids))]


# --- rules --------------------------------------------------------------------------------------


def rules_by_hand(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


def test_statistics_equal_brute_force():
    random.seed(5)
    for text in ODD[:5] + ["a b c a b c", "a b a b a b", "x\x1cy z  #*", "l one\nl one\n\n\nl one\r\nl one"]:
        assert quality_rules.statistics(text) == rules_by_hand(text)
    for _ in range(200):
        text = "".join(random.choice(["a", "b", "é", " ", "\n", "#", "<", "\t", "ab ", "b a ", "\x1f"]) for _ in range(random.randint(0, 80)))
        assert quality_rules.statistics(text) == rules_by_hand(text)


def test_rules_keep_good_rows_and_drop_symbol_junk(given):
    docs, labels = given
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, labels).collect()}
    good = [rows[r["doc_id"]] for r in labels.collect() if r["quality"] == 1]
    assert np.mean([r["kept"] for r in good if not r["base_failed"]]) > 0.99
    assert not any(r["kept"] for r in rows.values() if r["base_failed"])
    junk = [r for r in rows.values() if not r["base_failed"] and r["n_symbols"] > 2 * r["n_words"]]
    assert junk and np.mean([r["kept"] for r in junk]) < 0.2


def test_repetition_just_under_the_rules_is_rejected(given, make_docs, spark):
    docs, labels = given
    random.seed(4)
    prose = [r["text"].split() for r in docs.join(labels.where("quality = 1"), "doc_id").limit(40).collect() if len(r["text"].split()) >= 200]

    def repeating(each):
        fresh, phrase = each[:110], each[110:119]
        return " ".join(fresh + phrase * 10)  # 90 of 200 words in repeated windows

    def lines(each):
        return "\n".join(" ".join(each[i : i + 6]) for i in range(0, 180, 6)) + "\n" + "\n".join([" ".join(each[:6])] * 12)

    junk = {-10 - i: repeating(e) for i, e in enumerate(prose)} | {-100 - i: lines(e) for i, e in enumerate(prose)}
    junk |= {-200 - i: " ".join(w + "#" * (k % 2) for k, w in enumerate(e)) for i, e in enumerate(prose)}
    plain = {-300 - i: " ".join(e[:200]) for i, e in enumerate(prose)}
    made = make_docs(list((junk | plain).items())).select("doc_id", "text")
    rows = {r["doc_id"]: r for r in quality_rules.apply_rules(docs.select("doc_id", "text").union(made), labels).collect()}
    assert not any(rows[i]["base_failed"] for i in junk)
    for first in (-10, -100, -200):
        kept = [rows[i]["kept"] for i in junk if first >= i > first - 90]
        assert len(kept) == len(prose) and np.mean(kept) < 0.1, first
    assert np.mean([rows[i]["kept"] for i in plain]) > 0.9


def path_by_hand(forest, row):
    inner, total = forest.feature.shape[1], 0.0
    for t in range(len(forest.feature)):
        def walk(node):
            if node >= inner:
                return forest.path[t, node - inner]
            f = forest.feature[t, node]
            return walk(2 * node + 1 + int(f >= 0 and row[f] > forest.threshold[t, node]))
        total += walk(0)
    return total / len(forest.feature)


def boxes_by_hand(forest, sample_size):
    """Path lengths follow from the splits alone: level plus the mean path of what a box holds, at least its level."""
    return all(0 < p <= np.log2(forest.path.shape[1]) + quality_rules.mean_path(sample_size) for p in forest.path[forest.path > 0])


def test_forest_scores_equal_walking_each_tree():
    random_ = np.random.default_rng(2)
    low, high = np.array(quality_rules.RANGES).T
    x = low + (high - low) * random_.beta(1, 8, size=(500, 4))
    good = random_.random(500) < 0.8
    forest = quality_rules.fit_forest(x, good, trees=9, rows=64)
    want = [2.0 ** -(path_by_hand(forest, row) / forest.scale) for row in x]
    assert np.allclose(forest.scores(x), want) and boxes_by_hand(forest, 64)
    far = np.array([high])
    assert forest.scores(far)[0] > np.quantile(forest.scores(x[good]), 0.99)


def test_calibration_equals_trying_every_limit():
    random_ = np.random.default_rng(3)
    for n_bad in (0, 1, 30):
        scores = np.round(np.concatenate([random_.normal(0.4, 0.05, 1500), random_.normal(0.5, 0.05, n_bad)]), 3)
        good = np.arange(len(scores)) < 1500
        limit = quality_rules.calibrated(scores, good)
        least = sorted(scores[good])[int(np.ceil((1 - quality_rules.FALSE_ALARMS) * 1499))]

        def gain(at):
            caught = (scores[~good] > at).sum() / max(1, n_bad)
            return caught - quality_rules.COST * (scores[good] > at).mean()

        assert limit >= least and (scores[good] > limit).mean() <= quality_rules.FALSE_ALARMS
        assert gain(limit) == pytest.approx(max(gain(at) for at in scores if at >= least))


def test_every_labelled_document_teaches_the_forest(make_docs, spark):
    """Counted in tasks the forest is the one of all rows at hand, beyond 20,000 rows and a tree's 1,024 as well."""
    ids = [i for i in range(26_500) if zlib.crc32(str(i).encode()) % 5]
    assert len(ids) > 20_000
    prose = [" ".join(f"w{i}x{k}" + "y" * (i % 4) + "#" * (k < i % 12) for k in range(55)) for i in ids]
    docs = make_docs(list(zip(ids, prose))).repartition(3)
    labels = spark.createDataFrame([(i, int(i % 12 < 8)) for i in ids], "doc_id long, quality int")
    forest = quality_rules.fit(docs, labels)
    stats, good = np.array([quality_rules.statistics(t) for t in prose]), np.array([i % 12 < 8 for i in ids])
    whole = quality_rules.fit_forest(quality_rules.features(stats), good)
    assert np.allclose(forest.path, whole.path) and forest.scale == whole.scale
    x = quality_rules.features(stats)
    assert (forest.anomalous(x) == whole.anomalous(x)).all()
    counts = quality_rules.leaf_counts(forest, x[good])
    assert (counts.sum(axis=1) == good.sum()).all()  # no good row is left out of any tree


def test_boxes_equal_growing_each_tree():
    random_ = np.random.default_rng(9)
    low, high = np.array(quality_rules.RANGES).T
    x = low + (high - low) * random_.beta(1, 6, size=(700, 4))
    splits = quality_rules.random_splits(5, 64, seed=3)
    forest = quality_rules.with_paths(splits, quality_rules.leaf_counts(splits, x), 64)
    inner = splits.feature.shape[1]

    def grow(t, node, level, part):
        held = len(part) * 64 / 700
        if node >= inner or held <= 1:
            first, last = node, node
            while first < inner:
                first, last = 2 * first + 1, 2 * last + 2
            assert np.allclose(forest.path[t, first - inner : last - inner + 1], level + quality_rules.mean_path(held))
            return
        right = part[:, splits.feature[t, node]] > splits.threshold[t, node]
        grow(t, 2 * node + 1, level + 1, part[~right])
        grow(t, 2 * node + 2, level + 1, part[right])

    for t in range(5):
        grow(t, 0, 0, x)


def test_rules_edge_cases(make_docs, spark):
    docs = make_docs([*enumerate(ODD), (1, "again"), (None, "w " * 60 + "1 2 3")], extra=("n_words", "kept", "base_failed", "_good"))
    labels = spark.createDataFrame([(1, None), (2, 1), (6, 1), (None, 0)], "doc_id long, quality int")
    out = quality_rules.apply_rules(docs, labels)
    assert len(set(out.columns)) == len(out.columns) and out.count() == len(ODD) + 2
    assert quality_rules.apply_rules(make_docs([]), labels).count() == 0
    assert quality_rules.apply_rules(docs, labels.limit(0)).where("kept = base_failed").count() == 0


# --- personal data ------------------------------------------------------------------------------


def luhn_by_hand(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def spans_by_hand(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m[0])) <= 19 and luhn_by_hand(digits(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns():
    random.seed(6)
    bits = ["a@b.c", "@", ".", "x", "é", "1", "25", "256", "0", " ", "-", "+", "(", ")", "4111 1111 1111 1111", "4571475004921503",
            "+1 (873) 555-4781", "1.2.3.4", "user.name+x@ex-ample.co.uk", "00000000000012", "\n", "٣"]
    for _ in range(6000):
        text = "".join(random.choice(bits) for _ in range(random.randint(0, 14)))
        assert pii.base_spans(text) == spans_by_hand(text), repr(text)


def test_long_runs_are_linear():
    for text in ("9" * 400_000, "1." * 100_000, "a@" * 100_000, "x" * 500_000 + "@", "+1" + " " * 300_000):
        pii.base_spans(text)


def test_best_segmentation_equals_trying_all():
    random.seed(7)
    field = pii.Field()
    text = "12 345-6789 x@y.z (12)"
    region = next(pii.regions(text))
    ends = field.candidates(text, region)
    for here in ends:
        for _, label, features in here:
            for f in features:
                field.weights[label, f] = field.weights.get((label, f)) or random.gauss(0, 1)

    def every(j):
        if j == 0:
            yield 0.0
        else:
            for i, label, f in ends[j - 1]:
                for rest in every(i):
                    yield rest + field.score(label, f)

    found = field.best(text, region)
    inside = {k for i, j, _, _ in found for k in range(i, j + 1)}
    score = sum(field.score(k, next(f for s, l, f in ends[j] if s == i and l == k)) for i, j, k, _ in found)
    score += sum(field.score("O", next(f for s, l, f in ends[j] if l == "O")) for j in range(len(ends)) if j not in inside)
    assert abs(score - max(every(len(ends)))) < 1e-9


def test_gradient_equals_enumerating_all_segmentations():
    random.seed(9)
    text = "12 345-6789 x@y.z (12)"
    region = next(pii.regions(text))
    field = pii.Field()
    ends = field.candidates(text, region)
    for label, f in {(label, f) for here in ends for _, label, features in here for f in features}:
        field.weights[label, f] = random.gauss(0, 0.3)
    gold = [(1, 2, "phone")]

    def every(j):
        """(score, features with their labels) of each segmentation of the first j tokens."""
        if j == 0:
            yield 0.0, Counter()
            return
        for i, label, features in ends[j - 1]:
            for rest, seen in every(i):
                yield rest + field.score(label, features), seen + Counter((label, f) for f in features)

    whole = list(every(len(ends)))
    total = sum(np.exp(s) for s, _ in whole)
    want = Counter()
    for s, seen in whole:
        for key, times in seen.items():
            want[key] -= times * np.exp(s) / total
    at = {(i, j): (label, features) for j, here in enumerate(ends) for i, label, features in here if (i, j, label) in gold or label == "O"}
    for key in [(0, 0), (1, 2), (3, 3)]:
        label, features = at[key]
        want.update((label, f) for f in features)
    before = dict(field.weights)
    field._update(ends, gold, 1.0)
    for key, change in want.items():
        assert field.weights[key] - before[key] == pytest.approx(change, abs=2e-3), key


def test_long_entities_and_regions(make_docs):
    pairs = "+12 34 56 78 90 12 34"  # seven groups of digits
    assert [s for s in pii.base_spans(f"call {pairs} now")] == [("phone", 5, 5 + len(pairs))]
    assert [e[2] for e in pii.examples_of(f"call {pairs} now")][0] == [("phone", 0, len(pairs))]
    singles = "+" + " ".join("123456789")  # nine tokens: longer than a segment may be, so it teaches nothing
    assert pii.base_spans(singles) and list(pii.examples_of(singles)) == []
    many = [f"x {i} y" for i in range(300)]
    chosen = pii.teaching(" z ".join(many), 64, 400)
    assert len(chosen) == 64 and {e[1] for e in chosen} != {str(i) for i in range(64)}
    docs = [(i, f"phone +1 (873) 555-47{i % 90 + 10} or call 12 34 56 78 90 12") for i in range(50)]
    repeated = docs + [docs[0]] * 300  # one id with very many rows does not fill the sample
    assert pii.fit(make_docs(docs), limit=40).weights == pii.fit(make_docs(repeated), limit=40).weights


def test_field_adds_spans_the_patterns_miss(given, make_docs):
    field = pii.fit(given[0])
    docs = make_docs([
        (1, "call (873) 555-4781 or 1-873-555-4781 now"), (2, "version 2.0 of 17 items in 1999, 3.5 percent"),
        (3, "card 4571475004921503 4571475004921503 here"), (4, None), (5, "+1 (873) 555-4781 10.1.2.3"), (5, ""), (None, "a@b.co"),
    ], extra=("base", "spans", "kind", "before"))
    rows = pii.find(docs, field).select("doc_id", "base", "spans").collect()
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in rows if r["doc_id"] != 5}
    assert ("phone", 5, 19) in found[1] and ("phone", 23, 37) in found[1]
    assert found[2] == [] and found[4] == [] and found[None] == [("email", 0, 6)]
    assert [s[0] for s in found[3]] == ["card", "card"]
    for r in rows:
        assert {(s["kind"], s["start"], s["end"]) for s in r["base"]} <= {(s["kind"], s["start"], s["end"]) for s in r["spans"]}


def test_no_text_teaches_nothing(make_docs):
    field = pii.fit(make_docs([]))
    assert not field.weights
    assert pii.find(make_docs([(1, "1 2 3 4 (873) 555-4781")]), field).first()["spans"] == []
    assert pii.find(make_docs([]), field).count() == 0
