"""Personal data in text: fixed patterns, completed by a semi-Markov conditional random field.

The patterns give the base spans. The field looks at regions of neighbouring tokens with digits or an at
sign, scores whole candidate segments of at most ``MAX_TOKENS`` tokens by features of the entire span, and a
dynamic program over segment ends chooses boundaries and types together. It learns from the base spans of a
bounded sample, and from copies of them with prefixes and separators changed, so that it also knows spans
that the patterns miss; those that touch no base span are added.

Bounds, all on what is learnt from but for the first: an entity has at most ``MAX_TOKENS`` tokens separated by
single spaces (15 digits in pairs are 8), while base spans may have any number; regions with a longer base
span teach nothing. At most ``MAX_TRAINING_DOCS`` documents, ``MAX_REGIONS_PER_DOC`` regions of one, chosen by
hash, regions of at most ``MAX_REGION_CHARS`` characters, and ``MAX_TRAINING_REGIONS`` regions in all.

Offsets count code points, ends are exclusive. Null and empty texts have no spans; texts and spans are read
whole, however long. Repeated rows get the same spans and teach once. Without documents to learn from, and in
an empty table, the base spans are all there is. Extra columns pass through; columns named like the outputs
are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
import heapq
import math
import random
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 8
MAX_TRAINING_DOCS = 4_000
MAX_TRAINING_REGIONS = 6_000
MAX_REGIONS_PER_DOC = 64
MAX_REGION_CHARS = 400
Span = tuple[str, int, int]

# The base patterns. Each is anchored where its leftmost match has to begin, so that no
# long run of characters is tried again from each of its positions.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind and then start; matches that fail their check are dropped."""
    spans: list[Span] = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 16 <= len(m[0]) < 40 and 16 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


# --- the field ----------------------------------------------------------------------------------

HINT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = frozenset(" \t\n\x0b\x0c\r")
EDGE_LEFT, EDGE_RIGHT = "\"'.,;:!?[]{}<>|*#$%&=", "\"'.,;:!?[]{}<>|*#$%&=("
ADDRESS = re.compile(r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}")
Region = tuple[list[tuple[int, int]], str]  # token offsets, and the word before


def regions(text: str) -> Iterator[Region]:
    """Runs of tokens with a digit or an at sign, separated by single spaces, with the word before."""
    tokens: list[tuple[int, int]] = []
    position = 0
    hint = HINT.search(text)
    while hint:
        start = hint.start()
        while start > position and text[start - 1] not in SPACE:
            start -= 1
        end = TOKEN.match(text, start).end()
        if tokens and not (start == tokens[-1][1] + 1 and text[start - 1] == " "):
            yield tokens, word_before(text, tokens[0][0])
            tokens = []
        tokens.append((start, end))
        position = end
        hint = HINT.search(text, end)
    if tokens:
        yield tokens, word_before(text, tokens[0][0])


def word_before(text: str, start: int) -> str:
    before = text[max(0, start - 24) : start].split()
    return before[-1].strip(".,:;!?\"'=(").lower() if before else ""


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in EDGE_LEFT:
        start += 1
    while end > start and text[end - 1] in EDGE_RIGHT:
        end -= 1
    if text[start:end].startswith("(") and ")" not in text[start:end]:
        start += 1
    return start, end


def span_features(value: str, n_tokens: int, before: str) -> list[str]:
    """Features of a whole segment: digit count, grouping, checks and shape, not of single tokens."""
    digits = only_digits(value)
    n = len(digits)
    groups = re.findall("[0-9]+", value)
    rest = set(value) - set("0123456789")
    out = [
        f"n={n if n < 20 else 20}",
        f"groups={min(len(groups), 7)}",
        f"tokens={n_tokens}",
        "shape=" + "-".join(str(min(len(g), 9)) for g in groups[:6]),
        "plus" if value[:1] == "+" else "noplus",
        "letters" if any(c.isalpha() for c in rest) else "noletters",
        "only:" + "".join(sorted(c for c in rest if not c.isalnum()))[:6],
    ]
    if ADDRESS.fullmatch(value):
        out.append("address")
    elif "@" in value:
        out.append("at")
    if value.count(".") == 3 and len(groups) == 4 and rest == {"."}:
        out.append("octets" if all(int(g[-4:]) <= 255 for g in groups) else "badoctets")
    if 13 <= n <= 19 and rest <= {" ", "-"}:
        out.append("luhn" if luhn(digits) else "noluhn")
    if before in {"tel", "phone", "call", "fax", "mobile", "mail", "email", "e-mail", "contact", "ip", "card", "version"}:
        out.append(f"before={before}")
    return out


Weights = dict[tuple[str, str], float]
Segment = tuple[int, str, list[str]]  # first token, label, features


class Field:
    """Segment labels are the kinds, or "O" for a single token outside; weights are per (label, feature)."""

    def __init__(self, weights: Weights | None = None):
        self.weights: Weights = defaultdict(float, weights or {})

    def candidates(self, text: str, region: Region) -> list[list[Segment]]:
        """Per segment end, the possible segments; the number is linear in the tokens."""
        tokens, before = region
        ends: list[list[Segment]] = []
        for j in range(len(tokens)):
            here: list[Segment] = []
            for i in range(max(0, j - MAX_TOKENS + 1), j + 1):
                start, end = trimmed(text, tokens[i][0], tokens[j][1])
                features = span_features(text[start:end], j - i + 1, before if i == 0 else "")
                here += [(i, kind, features) for kind in KINDS]
                if i == j:
                    here.append((i, "O", features))
            ends.append(here)
        return ends

    def score(self, label: str, features: list[str]) -> float:
        return sum(self.weights.get((label, f), 0.0) for f in features)

    def best(self, text: str, region: Region) -> list[tuple[int, int, str, float]]:
        """The best segmentation's entities: (first token, last token, kind, lead over all outside)."""
        tokens = region[0]
        total, back = [0.0], []
        outside: list[float] = []
        for j, here in enumerate(self.candidates(text, region)):
            scored = [(total[i] + self.score(label, f), i, label) for i, label, f in here]
            outside.append(next(self.score("O", f) for i, label, f in here if label == "O"))
            value, i, label = max(scored, key=lambda s: s[0])
            total.append(value)
            back.append((i, label))
        found, j = [], len(tokens)
        while j:
            i, label = back[j - 1]
            if label != "O":
                found.append((i, j - 1, label, total[j] - total[i] - sum(outside[i:j])))
            j = i
        return found[::-1]

    def learn(self, examples: list[tuple[str, Region, list[tuple[int, int, str]]]], rounds: int = 6, rate: float = 0.3):
        """Stochastic gradient ascent on the conditional log-likelihood, by forward and backward sums."""
        order = random.Random(0)
        prepared = [(self.candidates(text, region), gold) for text, region, gold in examples]
        for turn in range(rounds):
            order.shuffle(prepared)
            step = rate / (1 + turn)
            for ends, gold in prepared:
                self._update(ends, gold, step)
        return self

    def _update(self, ends: list[list[Segment]], gold: list[tuple[int, int, str]], step: float) -> None:
        n = len(ends)
        scores = [[self.score(label, f) for _, label, f in here] for here in ends]
        forward = [0.0] + [-math.inf] * n
        for j in range(n):
            forward[j + 1] = log_sum([forward[i] + s for (i, _, _), s in zip(ends[j], scores[j])])
        backward = [-math.inf] * n + [0.0]
        onward: list[list[float]] = [[] for _ in range(n + 1)]
        for j in range(n - 1, -1, -1):
            backward[j + 1] = log_sum(onward[j + 1]) if j + 1 < n else 0.0
            for (i, _, _), s in zip(ends[j], scores[j]):
                onward[i].append(s + backward[j + 1])
        kinds = {(i, j): kind for i, j, kind in gold}
        inside = {k for i, j, _ in gold for k in range(i, j + 1)}
        for j, here in enumerate(ends):
            for (i, label, features), s in zip(here, scores[j]):
                expected = math.exp(min(0.0, forward[i] + s + backward[j + 1] - forward[n]))
                true = kinds.get((i, j)) == label if label != "O" else j not in inside
                change = step * (true - expected)
                if abs(change) > 1e-4:
                    for f in features:
                        self.weights[label, f] += change


def log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


# --- training -----------------------------------------------------------------------------------


def gold_segments(text: str, region: Region, spans: list[Span]) -> list[tuple[int, int, str]]:
    """The base spans as runs of the region's tokens; of overlapping ones the first kind counts."""
    tokens, _ = region
    out: list[tuple[int, int, str]] = []
    for kind, start, end in spans:
        run = [k for k, (a, b) in enumerate(tokens) if a < end and start < b]
        free = not any(i <= k <= j for i, j, _ in out for k in run)
        if run and free:
            out.append((run[0], run[-1], kind))
    return out


def variants(text: str, kind: str) -> list[str]:
    """Other ways to write the same datum."""
    if kind == "phone":
        bare = text.lstrip("+")
        short = re.sub(r"^[0-9]{1,3}[ .-]+", "", bare)
        dashed = re.sub(r"[ ()]+", "-", bare).strip("-")
        return [bare, short, dashed, dashed.replace("-", ".")]
    if kind == "card":
        digits = only_digits(text)
        return [" ".join(digits[i : i + 4] for i in range(0, len(digits), 4)), digits]
    return []


def examples_of(text: str) -> Iterator[tuple[str, str, list[Span]]]:
    """(word before, region text, spans inside) of each region of a text, and of its variants."""
    spans = base_spans(text)
    for region in regions(text):
        tokens, before = region
        start, end = tokens[0][0], tokens[-1][1]
        own = [(k, a - start, b - start) for k, a, b in spans if start <= a and b <= end]
        if any(base_spans(text[a:b]) and not any(x < b - start and a - start < y for _, x, y in own) for a, b in tokens):
            continue  # a token would match alone, but a longer match that failed swallowed it: no clear answer
        if any(sum(x < b - start and a - start < y for a, b in tokens) > MAX_TOKENS for _, x, y in own):
            continue  # too long for a segment; its tokens are not "outside" either
        yield before, text[start:end], own
        if len(own) == 1:
            kind, a, b = own[0]
            for other in variants(text[start + a : start + b], kind):
                if other:
                    yield before, text[start : start + a] + other + text[start + b : end], [(kind, a, a + len(other))]


def teaching(text: str | None, most: int, longest: int) -> list[tuple[str, str, list[Span]]]:
    """At most ``most`` examples of a text, those with the smallest hash of region and word before."""
    found = [e for e in examples_of(text or "") if len(e[1]) <= longest]
    return heapq.nsmallest(most, found, key=lambda e: (zlib.crc32(f"{e[0]} {e[1]}".encode()), e[:2]))


def fit(
    docs: DataFrame,
    limit: int = MAX_TRAINING_DOCS,
    regions_limit: int = MAX_TRAINING_REGIONS,
    per_doc: int = MAX_REGIONS_PER_DOC,
    longest: int = MAX_REGION_CHARS,
) -> Field:
    """Learn from the base spans of at most ``limit`` documents with a digit or an at sign; see the module for the bounds."""
    hinted = docs.where(F.col("text").rlike("[0-9@]") & F.col("doc_id").isNotNull())
    chosen = hinted.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    @F.arrow_udf("array<struct<before: string, text: string, spans: array<struct<kind: string, a: int, b: int>>>>")
    def gather(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())]))
        row = pa.list_(pa.struct([("before", pa.string()), ("text", pa.string()), ("spans", kind)]))
        for batch in texts:
            found = [
                [
                    {"before": w, "text": t, "spans": [{"kind": k, "a": a, "b": b} for k, a, b in s]}
                    for w, t, s in teaching(value, per_doc, longest)
                ]
                for value in batch.to_pylist()
            ]
            yield pa.array(found, type=row)

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `limit` ids
        .select("doc_id", F.explode(gather("text")).alias("e"))
        .select(F.col("e.before"), F.col("e.text"), F.col("e.spans"))
        .distinct()
        .orderBy(F.xxhash64("text", "before"), "text", "before")
        .limit(regions_limit)
        .collect()
    )
    examples = []
    for row in rows:
        tokens = [m.span() for m in TOKEN.finditer(row["text"])]
        region = (tokens, row["before"])
        examples.append((row["text"], region, gold_segments(row["text"], region, [tuple(s) for s in row["spans"]])))
    return Field().learn(examples)


# --- application --------------------------------------------------------------------------------

MARGIN = 3.0  # an added span's odds against "outside" are at least e**3 : 1


def added_spans(field: Field, text: str, base: list[Span]) -> list[Span]:
    out: list[Span] = []
    taken = sorted((a, b) for _, a, b in base)
    for region in regions(text):
        for i, j, kind, lead in field.best(text, region):
            start, end = trimmed(text, region[0][i][0], region[0][j][1])
            if lead >= MARGIN and end > start and not any(a < end and start < b for a, b in taken):
                out.append((kind, start, end))
    return out


def render(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Add ``base`` and ``spans``: arrays of (kind, start, end), by kind and then start."""
    weights = dict(field.weights)

    @F.arrow_udf("struct<base: array<struct<kind: string, start: int, end: int>>,"
                 "spans: array<struct<kind: string, start: int, end: int>>>")  # fmt: skip
    def spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        own = Field(weights)
        for batch in texts:
            base, every = [], []
            for value in batch.to_pylist():
                value = value or ""
                fixed = base_spans(value) if HINT.search(value) else []
                more = added_spans(own, value, fixed) if HINT.search(value) else []
                ordered = sorted(fixed + more, key=lambda s: (KINDS.index(s[0]), s[1]))
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in fixed])
                every.append([{"kind": k, "start": a, "end": b} for k, a, b in ordered])
            yield pa.StructArray.from_arrays([pa.array(base, kind), pa.array(every, kind)], names=["base", "spans"])

    found = docs.withColumn("_found", spans(F.col(text)))
    return found.withColumns({"base": F.col("_found.base"), "spans": F.col("_found.spans")}).drop("_found")
