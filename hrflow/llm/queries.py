"""Registered queries of this subpackage and the SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hrflow.llm.conversation_repair import repair_conversations
from hrflow.llm.exact_dedup import exact_duplicates
from hrflow.llm.language_id import languages, train_languages
from hrflow.llm.merkle_manifest import folded, leaf_digest, merkle_manifest, proof_digest
from hrflow.llm.ngram_lm import bigram_scores, train_bigrams
from hrflow.llm.packing import pack
from hrflow.llm.repeats import remove_repeats
from hrflow.llm.secret_scan import secret_spans
from hrflow.llm.sentencepiece_codec import encoding_digest
from hrflow.llm.simhash_dedup import simhash_components
from hrflow.llm.topk_search import top_k
from hrflow.llm.toxicity import toxicity_scores, train_toxicity
from hrflow.llm.url_filter import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            CHECKS[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
with t as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id,
       first_value(doc_id) over best as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over best as kept,
       sha256(norm) as text_sha256
from t
window best as (partition by norm order by points desc, doc_id)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts by block naming."""
    return exact_duplicates(_table(spark, sf_dir, "documents")).drop("k1", "k2")


@query()
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of texts whose fingerprints differ in at most 3 bits."""
    return simhash_components(_table(spark, sf_dir, "documents"))


@query(r"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0),
r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
""")
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 50."""
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


#: (verdict, host, path) of the production rules.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query(r"""
with p as (
  select page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) as path
  from pages),
r(v, h, q) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                      ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m as (
  select page_id, max_by(struct_pack(rule := h || q, verdict := v), length(h || q)) as hit
  from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, q)
  group by page_id)
select p.page_id, host, path, hit.rule as rule, coalesce(hit.verdict, 'allow') as verdict
from p left join m using (page_id)
""")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for hosts and paths; a page that no rule fits is on no list and so allowed."""
    return url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def _crc(modulus: int):
    """The remainder of the id's CRC-32 as decimal text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus


#: A document is predicted toxic from this score on.
TOXIC_FROM = 0.3


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or of sentence scores, learned from the labels outside the held-out quarter."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = train_toxicity(docs.filter(_crc(4) != 2), labels)
    return toxicity_scores(docs, model).select(
        "doc_id",
        (_crc(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "worst_sentence",
    )


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language with most letters in the Viterbi path of each text, learned from two thirds of the documents."""
    docs = _table(spark, sf_dir, "documents")
    model = train_languages(docs.filter(_crc(3) != 1))
    return languages(docs, model).select("doc_id", (_crc(3) == 1).alias("held_out"), "lang_pred", "score")


@query()
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each text that no repeated string of 400 bytes covers."""
    return remove_repeats(_table(spark, sf_dir, "documents"))


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text under the 32k model, as count and checksum, and whether decoding gives back the text."""
    return encoding_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every text under a bigram model of the texts outside the held-out seventh."""
    docs = _table(spark, sf_dir, "documents")
    model = train_bigrams(docs.filter(_crc(7) != 2))
    scores = bigram_scores(docs, model)
    return scores.select(
        "doc_id",
        (_crc(7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@query()
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: the base patterns, and candidates that decode to keys or signed tokens."""
    found = secret_spans(_table(spark, sf_dir, "documents"))
    base = ("assign", "access", "hex")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")  # noqa: E731
    of_kind = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: E731
    return found.select(
        "doc_id",
        *map(of_kind, base),
        F.sha2(listed(F.filter("secrets", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        F.array_join(F.transform("secrets", lambda s: s["detail"]), ",").alias("details"),
    )


def _sql_crc(text: str) -> str:
    """CRC-32 of an ASCII text in SQL: eight shifts a byte, the byte enters at the first."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda b: [cast(ascii(b) as bigint), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, i) >> 1, 3988292384 * (xor(c, i) & 1))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {bits}), lambda c, i: {step}), 4294967295)"


def _sql_framed(column: str) -> str:
    return f"coalesce(strlen(cast({column} as varchar)) || ':' || cast({column} as varchar), '-')"


def _sql_merkle(levels: int = 8) -> str:
    """The tree level by level; a level leaves a group of one node as it is. ``levels`` suffice for 16 ** levels leaves."""
    text = "case when doc_id is not null and {crc} % 5 = 0 then translate(text, '{up}', '{low}') else text end".format(
        crc=_sql_crc("cast(doc_id as varchar)"), up="ABCDEFGHIJKLMNOPQRSTUVWXYZ", low="abcdefghijklmnopqrstuvwxyz"
    )
    leaf = lambda t: "sha256(" + " || ".join(_sql_framed(c) for c in ("doc_id", "source", "lang", "n_chars")) + f" || {_sql_framed(t)})"  # noqa: E731
    parts = [
        f"d as (select *, {leaf('text')} as leaf, {leaf('changed')} as forged from (select *, {text} as changed from documents))",
        "u0 as (select row_number() over (order by doc_id nulls first, leaf) as row, doc_id, source as g, leaf, forged, leaf as node, "
        "row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i from d)",
    ]

    def rise(a: str, b: str, g: str) -> str:
        many = f"count(*) over (partition by {g}) > 1"
        return (
            f"{b} as (select {g}, case when max(many) then min(i) // 16 else min(i) end as i, "
            f"case when max(many) then sha256(string_agg(node, '' order by i)) else min(node) end as node "
            f"from (select *, {many} as many from {a}) group by {g}, i // 16)"
        )

    def around(a: str, b: str, g: str) -> str:
        run = f"partition by {g}, i // 16 order by i rows between"
        return (
            f"{b} as (select {g}, i, coalesce(string_agg(node, '') over ({run} unbounded preceding and 1 preceding), '') as l, "
            f"coalesce(string_agg(node, '') over ({run} 1 following and unbounded following), '') as r, "
            f"count(*) over (partition by {g}) > 1 as many from {a})"
        )

    for k in range(levels):
        parts += [rise(f"u{k}", f"u{k + 1}", "g"), around(f"u{k}", f"a{k}", "g")]
    parts.append(f"v0 as (select 1 as one, g, node, row_number() over (order by g nulls first) - 1 as i from u{levels})")
    for k in range(levels):
        parts += [rise(f"v{k}", f"v{k + 1}", "one"), around(f"v{k}", f"b{k}", "one")]

    def up(before: str, after: str, side: str, same: str, mine: str) -> str:
        return (
            f"{after} as (select p.* exclude (k, proof, fold), case when s.many then k // 16 else k end as k, proof || s.l || s.r as proof, "
            f"case when s.many then sha256(s.l || fold || s.r) else fold end as fold from {before} p join {side} s on {same} and s.i = p.{mine})"
        )

    parts.append("p0 as (select row, doc_id, g, leaf, i as k, '' as proof, forged as fold from u0)")
    for k in range(levels):
        parts.append(up(f"p{k}", f"p{k + 1}", f"a{k}", "s.g is not distinct from p.g", "k"))
    parts.append(
        f"q0 as (select p.* exclude (k), v.i as k, v.node as subroot from p{levels} p join v0 v on v.g is not distinct from p.g)"
    )
    for k in range(levels):
        parts.append(up(f"q{k}", f"q{k + 1}", f"b{k}", "true", "k"))
    return (
        "with " + ",\n".join(p.replace(" as (", " as materialized (", 1) for p in parts) + f"\nselect doc_id, leaf, subroot, t.node as root, sha256(proof) as proof_sha256, "
        f"fold as folded_root, fold = t.node as verified from q{levels}, v{levels} t"
    )


@query(_sql_merkle())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash tree of all documents, and what the proofs say about texts that were tampered with."""
    docs = _table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    text = F.when(crc % 5 == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    forged = leaf_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text)
    found = merkle_manifest(docs, carry={"forged": forged})
    return found.withColumn("folded_root", folded(F.col("forged"), F.col("proof"))).select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _sql_repair() -> str:
    """The programme in SQL: a recursive query carries cost, audit and repaired text of the four states from row to row."""
    old = ["s0", "s1", "s2", "s3"]
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}

    def struct(p: int, cost: str, audit: str, body: str) -> str:
        return f"{{'c': {old[p]}.c + {cost}, 'a': {old[p]}.a || '{audit}', 'b': {old[p]}.b{body}}}"

    ways: list[list[str]] = [[], [], [], []]
    for p in range(4):
        for k in range(2):
            state = after[p] if k else p
            added = f" || '{name[state]}:'" if k and p == 0 else f" || chr(10) || '{name[state]}:'" if k else ""
            line = " || chr(10)" if state else ""
            ways[state].append(struct(p, f"{4 + 3 * k}", "I" * k + "D", added))
            new = after[state]
            stay = "case when n.gone then 1000000000 when n.cut then 3 else 0 end"
            kept = f"{3 * k} + {stay} + case when left(n.role, 1) = '{name[new][0]}' then 0 else 1000000000 end"
            ways[new].append(struct(p, kept, "I" * k + "K", f"{added}{line} || n.role || ':' || n.text"))
            ways[new].append(struct(p, f"{3 + 3 * k} + {stay}", "I" * k + "R", f"{added}{line} || '{name[new]}:' || n.text"))
            if state == 0:
                system = f"{stay} + case when left(n.role, 1) = 's' then 0 else 1000000000 end"
                ways[1].append(struct(p, system, "K", " || n.role || ':' || n.text"))
    steps = ", ".join(f"list_min([{', '.join(w)}]) as s{i}" for i, w in enumerate(ways))
    never = "{'c': cast(1000000000 as bigint), 'a': '', 'b': ''}"
    key = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"
    return rf"""
with recursive d as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_sql_crc(key)} % 20 as x from conversations),
t as (
  select conv_id, turn, case when x = 4 then 'user' else role end as role,
         case x when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from d, unnest(range(case x when 0 then 0 when 3 then 2 else 1 end))),
o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from t),
f as (
  select *, not regexp_matches(text, '[^ 	-]') as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
         not regexp_matches(text, '[.!?][ 	-]*$') as open,
         left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) as pair
  from o),
n as (
  select *, blank or again as gone, open and not blank and not again as cut from f),
r as (
  select conv_id, cast(0 as bigint) as i, {{'c': cast(0 as bigint), 'a': '', 'b': ''}} as s0, {never} as s1, {never} as s2, {never} as s3
  from (select distinct conv_id from conversations)
  union all
  select r.conv_id, n.i, {steps} from r join n on n.conv_id is not distinct from r.conv_id and n.i = r.i + 1),
e as (
  select conv_id, list_min([s0, s3, {{'c': s2.c + 3, 'a': s2.a || 'I', 'b': s2.b || chr(10) || 'assistant:'}}]) as s
  from r qualify row_number() over (partition by conv_id order by i desc) = 1),
k as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
         count(*) filter (again and not blank) as duplicate, count(*) filter (cut) as truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from n group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, s.c as cost, s.a as audit, sha256(s.b) as repaired_sha256
from e left join k on k.conv_id is not distinct from e.conv_id
"""


@query(_sql_repair())
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after damage that its rows' checksums decide: its faults and its cheapest repair."""
    turns = _table(spark, sf_dir, "conversations")
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))  # noqa: E731
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    damaged = turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"), (kind == 0).alias("dropped"), copies.alias("copy")
    )
    return repair_conversations(damaged, absent="dropped")
