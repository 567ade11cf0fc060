"""Queries over the whole given tables, and SQL with the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
import public_tokenizers

from ..session import scratch_path
from . import bpe, conversations, decontaminate, line_dedup, pii, prefix_trie, quality_model, quality_rules, secret_ledger, sharding, simhash, substring, whitening
from .common import joined_sha256, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query(
    "op1_de_bruijn_dedup",
    r"""
    with d as (
        select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
    ), windows as (
        select r, doc_id, s, sha256(array_to_string(w[s:s + 12], ' ')) as h
        from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as s from d where len(w) >= 13)
    ), firsts as (
        select h, min(doc_id) as first from windows group by h
    ), gone as (
        select distinct r, unnest(range(s, s + 13)) as p from windows join firsts using (h) where doc_id > first
    ), tokens as (
        select r, unnest(w) as word, generate_subscripts(w, 1) as p from d
    ), kept as (
        select r, string_agg(word, ' ' order by p) as text, count(*) as n
        from tokens anti join gone using (r, p) group by r
    )
    select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
    from d left join kept using (r)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    reduced = substring.remove_repeats(documents(spark, sf_dir))
    return reduced.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@query("op2_quality_trees")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_model.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return bpe.round_trip(documents(spark, sf_dir), path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        joined_sha256(F.col("ids"), " ").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_semi_markov_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.fit(docs)).drop("text")

    def rendered(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, pii.KINDS),
        F.sha2(rendered("base").cast("binary"), 256).alias("base_sha256"),
        rendered("spans").alias("spans"),
    )


@query(
    "op5_positional_decontamination",
    r"""
    with d as (
        select row_number() over () as r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
    ), b as (
        select item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where item_id is not null
    ), windows as (
        select item_id, least(len(w), 10) as k, array_to_string(w[s:s + 9], ' ') as phrase
        from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from b where len(w) > 0)
    ), places as (
        select r, s, k, array_to_string(w[s:s + k - 1], ' ') as phrase
        from (select r, w, k, unnest(range(1, len(w) - k + 2)) as s
              from d, (select distinct k from windows) where len(w) >= k)
    ), hits as (
        select distinct r, s, k, item_id from places join windows using (k, phrase)
    ), covered as (
        select r, count(distinct p) as n_hit from (select r, unnest(range(s, s + k)) as p from hits) group by r
    ), items as (
        select r, count(*) as n, string_agg(i, ',' order by i) as ids
        from (select distinct r, cast(item_id as varchar) as i from hits) group by r
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n, 0) as n_items,
           sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join covered using (r) left join items using (r)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        joined_sha256(F.col("items"), ",").alias("items_sha256"),
        "contaminated",
    )


@query("op6_simhash_tiles")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op7_isolation_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.STATISTICS, "base_failed", "kept")


@query(
    "op8_line_dedup",
    r"""
    with lines as (
        select doc_id, i, line, translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                     generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)
    ), shared as (
        select key, min(doc_id) as first from lines where length(key) >= 10
        group by key having count(distinct doc_id) >= 2
    ), marked as (
        select l.*, s.first is not null and l.doc_id > s.first as gone from lines l left join shared s using (key)
    )
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op9_hash_tree_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    sized = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.assign(sized, sharding.even_tree(), grown_by=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query(
    "op10_snapshot_collapse",
    r"""
    with turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, role, text) as n
        from (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
              from conversations where conv_id is not null)
    ), prefixes as (
        select conv_id, n, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
                               over (partition by conv_id order by n)) as h from turns
    ), whole as (
        select conv_id, max(n) as total, arg_max(h, n) as h from prefixes group by conv_id
    ), finals as (
        select h, min(conv_id) as conv_id from whole group by h
    ), proper as (
        select distinct p.h from prefixes p join whole w using (conv_id) where p.n < w.total
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' order by n)) as text_sha256
    from turns join (select conv_id from finals where h not in (select h from proper)) using (conv_id)
    group by conv_id
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = conversations.collapse_snapshots(table(spark, sf_dir, "conversations"))
    return kept.select("conv_id", "n_turns", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query(
    "op11_prefix_trie",
    """
    with turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as n
        from conversations where conv_id is not null
    ), ids as (
        select conv_id, count(*) as own, cast(conv_id as varchar) as digits from turns group by conv_id
    ), hashed as (
        select conv_id, own, conv_id - conv_id % 100 as base,
               xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(digits, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
                               lambda crc, b: xor(xor(crc, b) >> 1, (xor(crc, b) & 1) * 3988292384)), 4294967295) % 6 as h
        from ids
    ), plan as (
        select c.conv_id, c.own, c.base, c.h, least(c.h, coalesce(b.own, 0)) as taken
        from hashed c left join ids b on b.conv_id = c.base
    ), rebuilt as (
        select p.conv_id, t.n as depth, role, text from plan p join turns t on t.conv_id = p.base and t.n <= p.taken
        union all
        select p.conv_id, t.n - p.h + p.taken, role, text from plan p join turns t on t.conv_id = p.conv_id and t.n > p.h
    ), prefixes as (
        select conv_id, depth, length(text) as chars,
               sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (partition by conv_id order by depth)) as h
        from rebuilt
        union all
        select conv_id, 0, 0, '' from ids
    ), lengths as (
        select conv_id, max(depth) as length from prefixes group by conv_id
    ), nodes as (
        select depth, h, min(conv_id) as node, count(*) as n_convs, max(chars) as chars from prefixes group by depth, h
    ), places as (
        select p.conv_id, p.depth, n.node from prefixes p join nodes n using (depth, h)
    ), linked as (
        select n.node, n.depth, p.node as parent, n.n_convs, (n.n_convs - 1) * n.chars as saved
        from nodes n left join places p on p.conv_id = n.node and p.depth = n.depth - 1
    ), children as (
        select parent as node, depth - 1 as depth, count(*) as n from linked where parent is not null group by all
    ), sums as (
        select p.node, p.depth, count(*) filter (c.n is null) as n_leaves, sum(l.saved)::bigint as saved_tokens
        from linked l left join children c on c.node = l.node and c.depth = l.depth
        join places p on p.conv_id = l.node and p.depth <= l.depth
        group by p.node, p.depth
    ), ends as (
        select node, depth, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256
        from places join lengths using (conv_id) where depth = length group by node, depth
    )
    select l.node as conv_id, l.depth, l.parent as parent_conv_id, l.n_convs, coalesce(c.n, 0) as n_children,
           s.n_leaves, s.saved_tokens, coalesce(e.ends_sha256, sha256('')) as ends_sha256
    from linked l left join children c on c.node = l.node and c.depth = l.depth
    join sums s on s.node = l.node and s.depth = l.depth
    left join ends e on e.node = l.node and e.depth = l.depth
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), openings=True)


@query("op12_bit_sliced_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def sql_spans(rule: secret_ledger.Rule, place: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
        select r, {place} as place, '{rule.kind}' as kind, spans.b as b, spans.e as e from (
            select r, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
                'b': list_sum(list_transform(p[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0),
                'e': list_sum(list_transform(p[:i], lambda x: length(x))) + list_sum(list_transform(m[:i], lambda x: length(x))),
                'n': length(c[i])}})) as spans
            from (select r, regexp_split_to_array(text, '{pattern}') as p, regexp_extract_all(text, '{pattern}') as m,
                         regexp_extract_all(text, '{pattern}', {rule.group}) as c from d)
        ) where spans.n >= {rule.least}"""


@query(
    "op13_secret_ledger",
    f"""
    with d as (
        select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
    ), spans as ({" union all ".join(sql_spans(rule, i) for i, rule in enumerate(secret_ledger.RULES))}
    ), joined as (
        select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
               count(*) filter (kind = 'hex') as n_hex,
               string_agg(kind || ':' || b || ':' || e, ',' order by b, place) filter (place < {len(secret_ledger.BASE)}) as base,
               string_agg(kind || ':' || b || ':' || e, ',' order by b, place) as every
        from spans group by r
    )
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(every, '') as spans
    from d left join joined using (r)
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secret_ledger.Ledger(spark, scratch_path(spark, "secret-ledger"))
    found = secret_ledger.scan(ledger, documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_ledger.BASE]))

    def rendered(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(r.kind) for r in secret_ledger.BASE),
        F.sha2(rendered(base).cast("binary"), 256).alias("base_sha256"),
        rendered(F.col("spans")).alias("spans"),
    )


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return import_module("corpus_pipeline").run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
