"""Secret scans with a ledger of scanned content, in DataFrame operations only.

Every version of every file is addressed by the SHA-256 of its text, its blob. A rule has a name and a version.
The ledger says which blob was scanned with which rule version and what was found. A scan looks up which
(blob, rule version) pairs are not in the ledger yet, reads the text of one file for each such blob, applies
only the rules that are missing, appends one folder to the ledger, and joins the findings of all blobs back to
all files. So copies, unchanged files and old versions that return cost a look-up, and a changed rule is the
only one that runs again.

A run's folder counts once Spark has marked it as complete; a run that died leaves nothing that counts, and one
that is repeated finds its pairs in the ledger. Findings of rule versions that are no longer asked for stay in
the ledger and out of the result. Two runs at the same time may both scan a pair; findings are sets, so
nothing doubles.

Offsets count code points, ends are exclusive. A match is the leftmost one after the end of its rule's last
match; one that fails the rule's length check is dropped and its characters are not tried again. A null text
counts as empty. Repeated rows and equal texts get equal results, rows stay as many as they are, and keys may
be null. Extra columns pass through; columns named like an output (``blob``, ``spans``) are replaced. An empty
table gives an empty result and leaves the ledger as it is. A text is read whole, however long.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import child_names, staged

SPANS = "array<struct<kind:string,start:int,end:int>>"
SCANS = f"blob string, rules array<string>, spans {SPANS}"
# Blobs up to which the list of what to scan is broadcast, after counting it (2 MB); beyond, the join shuffles.
MAX_BROADCAST_BLOBS = 10_000


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if its group ``group`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    mark: str = ""  # plain text that every match holds, looked for first

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules. Where the length check can stand in the pattern without changing a match, it does.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
BASE = (
    Rule("assign", 1, ASSIGN, group=2, least=8),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}", mark="AKIA"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
# Formats that issuers publish; each has a mark that prose does not have.
ISSUED = (
    Rule("github", 1, "gh[oprsu]_[A-Za-z0-9]{36,}", mark="gh"),
    Rule("slack", 1, "xox[abeprs]-[A-Za-z0-9-]{10,}", mark="xox"),
    Rule("google", 1, "AIza[A-Za-z0-9_-]{35,}", mark="AIza"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", mark="eyJ"),
    Rule("private_key", 1, "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", mark="PRIVATE KEY-----"),
)
RULES = BASE + ISSUED


def pieces(text: Column, rule: Rule) -> Column:
    """Code points before each match since the last one, in the match, and in its checked group; null if none.

    The text after the last match ends the list, without a match.
    """
    found = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("checked"),
    )
    lengths = F.transform(found, lambda p: F.struct(*(F.char_length(p[k]).alias(k) for k in ("before", "match", "checked"))))
    return F.when(F.contains(text, F.lit(rule.mark)) & text.rlike(rule.pattern), lengths)


def located(hits: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, spans) from (blob, hits): the pieces of each rule add up to the offsets."""
    each = hits.select("blob", F.explode("hits").alias("hit")).select("blob", "hit.kind", F.posexplode("hit.pieces").alias("n", "p"))
    line = W.partitionBy("blob", "kind").orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum(F.col("p.before") + F.coalesce("p.match", F.lit(0))).over(line).cast("int")
    least = F.create_map(*(x for r in rules for x in (F.lit(r.kind), F.lit(r.least))))
    spans = each.withColumn("end", end).where(F.col("p.checked") >= least[F.col("kind")])
    span = F.struct("kind", (F.col("end") - F.col("p.match")).alias("start"), "end")
    return spans.groupBy("blob").agg(F.collect_list(span).alias("spans"))


def ordered(spans: Column, rules: Sequence[Rule]) -> Column:
    """Spans by start, then by the place of their kind among the rules."""
    place = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], place[s["kind"]], s["end"], s["kind"])))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


@dataclass(frozen=True)
class Ledger:
    """Folders ``scan-…`` below ``root``, one per run, with one row per scanned blob: blob, rules, spans."""

    spark: SparkSession
    root: str

    def runs(self) -> list[str]:
        names = (f"{self.root}/{n}" for n in child_names(self.spark, self.root) if n.startswith("scan-"))
        return [p for p in sorted(names) if "_SUCCESS" in child_names(self.spark, p)]

    def scans(self) -> DataFrame:
        paths = self.runs()
        if not paths:
            return self.spark.createDataFrame([], SCANS)
        return self.spark.read.schema(SCANS).parquet(*paths)

    def missing(self, addressed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
        """(blob, pick, rules): blobs with rules that were not applied to them, and which of their rows to read."""
        blobs = addressed.groupBy("blob").agg(F.min("pick").alias("pick"))
        done = self.scans().select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        wanted = F.array(*(F.lit(r.id) for r in rules))
        left = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
        return blobs.join(done, "blob", "left").select("blob", "pick", left.alias("rules")).where(F.size("rules") > 0)

    def append(self, texts: DataFrame, rules: Sequence[Rule]) -> None:
        """Scan rows (blob, rules, text) and add them to the ledger."""
        wanted = (F.when(F.array_contains("rules", r.id), pieces(F.col("text"), r)) for r in rules)
        hits = F.array(*(F.struct(F.lit(r.kind).alias("kind"), p.alias("pieces")) for r, p in zip(rules, wanted)))
        scanned = texts.select("blob", "rules", F.filter(hits, lambda h: h["pieces"].isNotNull()).alias("hits"))
        with staged(scanned.dropDuplicates(["blob"]), "scanned") as read:
            found = located(read, rules)
            spans = F.coalesce("spans", F.array().cast(SPANS))
            whole = read.select("blob", "rules").join(found, "blob", "left").select("blob", "rules", spans.alias("spans"))
            whole.write.parquet(f"{self.root}/scan-{uuid.uuid4().hex}")

    def findings(self, rules: Sequence[Rule]) -> DataFrame:
        """(blob, spans) of blobs where one of the rule versions found something."""
        kinds = {r.id: r.kind for r in rules}
        by_rule = self.scans().select("blob", "spans", F.explode("rules").alias("rule")).where(F.col("rule").isin(list(kinds)))
        kind = F.substring_index("rule", "@", 1)
        spans = by_rule.select("blob", F.explode(F.filter("spans", lambda s: s["kind"] == kind)).alias("span"))
        return spans.groupBy("blob").agg(ordered(F.collect_set("span"), rules).alias("spans"))


def scan(
    ledger: Ledger, versions: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``versions`` with the blob and the spans of each row, after the ledger has been brought up to date.

    ``keys`` tell versions apart (a path and a revision, for example); they only choose which of the rows with
    equal text is read.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    blob = F.sha2(value.cast("binary"), 256)
    addressed = versions.select(blob.alias("blob"), F.xxhash64(*keys).alias("pick"), value.alias("text"))
    with staged(ledger.missing(addressed.select("blob", "pick"), rules), "unscanned") as todo:
        n = todo.count()
        if n:
            few = F.broadcast(todo) if n <= MAX_BROADCAST_BLOBS else todo
            ledger.append(addressed.join(few, ["blob", "pick"]), rules)
    rest = versions.drop("blob", "spans")
    found = ledger.findings(rules).withColumnRenamed("blob", "_blob").withColumnRenamed("spans", "_spans")
    joined = rest.withColumn("blob", blob).join(found, F.col("blob") == F.col("_blob"), "left")
    return joined.withColumn("spans", F.coalesce("_spans", F.array().cast(SPANS))).drop("_blob", "_spans")
