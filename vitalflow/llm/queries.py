"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalflow.llm import (
    archives,
    exact_dedup,
    filter_audit,
    fingerprints,
    html_text,
    merkle,
    mixing,
    near_dedup,
    pieces,
    quality,
    sharding,
    token_files,
    toxicity,
)
from vitalflow.llm.common import documents, labels, pages
from vitalflow.session import fresh_path


def op1_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf))


def op2_mix(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix_plan(documents(spark, sf))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    _, groups = exact_dedup.exact_groups(documents(spark, sf))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    _, groups = near_dedup.near_groups(documents(spark, sf), size=3, percent=85)
    component = F.col("component_id")
    return groups.select(
        "doc_id", "n_shingles", "component_id", component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(documents(spark, sf), labels(spark, sf))


def op6_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    files = token_files.write_token_files(documents(spark, sf), tokenizer, folder)
    return token_files.token_file_sums(files, folder)


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract_pages(pages(spark, sf))


def op8_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf), public_tokenizers.path(pieces.MODEL))


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxic_scores(documents(spark, sf), labels(spark, sf))


def op10_archives(spark: SparkSession, sf: str) -> DataFrame:
    folder = fresh_path(spark, "archives")
    files = archives.write_archives(pages(spark, sf), folder)
    return archives.read_archives(files, folder).drop("url")


def op11_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.document_proofs(documents(spark, sf))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_documents(documents(spark, sf), labels(spark, sf))


def op13_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.document_shards(documents(spark, sf))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_mix": op2_mix,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality": op5_quality,
    "op6_token_files": op6_token_files,
    "op7_html_text": op7_html_text,
    "op8_pieces": op8_pieces,
    "op9_toxicity": op9_toxicity,
    "op10_archives": op10_archives,
    "op11_manifest": op11_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_shards": op13_shards,
}

OP2_SQL = r"""
with sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
  from sums),
steps as (
  select *, coalesce(sum(source_size) over w, 0) as over_size, coalesce(sum(weight) over w, 0) as over_weight
  from ranked
  window w as (order by 2.0 * source_size / weight, source
               rows between unbounded preceding and 1 preceding)),
rates as (
  select s.*, (1.5::double * t.total - 2.0::double * over_size) / (t.weights - over_weight) as rate
  from steps s, (select sum(source_size)::double as total, sum(weight)::double as weights from ranked) t),
chosen as (
  select rate from rates where rate * weight <= 2.0::double * source_size
  order by 2.0 * source_size / weight, source limit 1),
targets as (
  select source, source_size,
         least(2.0::double * source_size, weight::double * (select rate from chosen)) as target
  from ranked),
placed as (
  select s.doc_id, s.size, t.source_size, t.target,
         row_number() over (partition by s.source order by s.size desc, s.doc_id nulls last) as up_to,
         case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate,
         ('0x' || substr(md5('mix:' || coalesce(s.source, '')), 1, 8))::bigint / 4294967296.0::double
           as offset_
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
       ((floor(up_to * rate + offset_) - floor((up_to - 1) * rate + offset_)) * size)::bigint as taken
from placed
"""

OP3_SQL = r"""
with normal as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
  from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
       sha256(norm) as text_sha256
from normal
window g as (partition by norm)
"""

OP4_SQL = r"""
with recursive worded as (
  select doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingled as (
  select doc_id, list_distinct(case
    when len(w) = 0 then []::varchar[]
    when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
  end) as s from worded),
sized as (select doc_id, s, len(s) as n from shingled),
items as (select doc_id, n, unnest(s) as item from sized),
pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c
  from items a join items b on a.item = b.item and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id),
links as (select a, b from pairs where 100 * c >= 85 * (na + nb - c)),
edges as (select a, b from links union all select b, a from links),
reached(doc_id, seen) as (
  select doc_id, doc_id from sized
  union
  select r.doc_id, e.b from reached r join edges e on r.seen = e.a),
smallest as (select doc_id, min(seen) as component_id from reached group by doc_id)
select doc_id, n::bigint as n_shingles, component_id, doc_id = component_id as kept
from sized join smallest using (doc_id)
"""

OP10_SQL = r"""
with paged as (select page_id, coalesce(html, '') as html from pages),
kept as (select *, max(page_id) over (partition by html) as keeper, sha1(html) as hex from paged)
select page_id, strlen(html)::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 10 * (i // 8)::int, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31)::int,
         1)), '') as payload_digest,
       case when page_id is distinct from keeper then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from keeper then keeper end as refers_to
from kept
"""

def op11_sql(levels: int = 8, top_levels: int = 3) -> str:
    """Proofs with the levels written out: up to 8^8 documents a language, 8^3 languages."""
    field = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
    whole = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "unicode(substr(coalesce(doc_id::varchar, ''), i, 1)), -1, -1, -1, -1, -1, -1, -1, -1"
    steps = [
        f"""
with coded as materialized (
  select doc_id, coalesce('=' || lang, '-') as tree,
         sha256({whole.format(text="text")}) as leaf, sha256({whole.format(text=lower)}) as lowered,
         xor(4294967295, list_reduce(
           [4294967295] || flatten(list_transform(
             range(1, length(coalesce(doc_id::varchar, '')) + 1), lambda i: [{bits}])),
           lambda c, o: case when o >= 0 then xor(c, o)
                             else xor(c >> 1, 3988292384 * (c & 1)) end)) % 3 = 0 as tampered
  from documents),
placed as materialized (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from coded),
level0 as materialized (select tree, pos, leaf as h, count(*) over (partition by tree) as n from placed)"""
    ]

    def join_up(name: str, k: int) -> str:
        return f"""
{name}{k + 1} as materialized (
  select tree, pos // 8 as pos, any_value(n - 1) // 8 + 1 as n,
         case when any_value(n) = 1 then max(h) else sha256(string_agg(h, '' order by pos)) end as h
  from {name}{k} group by tree, pos // 8)"""

    def climb(name: str, level: str, k: int) -> str:
        return f"""
{name}{k + 1} as materialized (
  select w.row_no, w.tree, w.pos // 8 as pos, any_value(w.proof) ||
           coalesce(string_agg(l.h, '' order by l.pos) filter (l.pos <> w.pos), '') as proof,
         case when any_value(l.n) = 1 then any_value(w.now)
              else sha256(coalesce(string_agg(l.h, '' order by l.pos) filter (l.pos < w.pos), '') ||
                          any_value(w.now) ||
                          coalesce(string_agg(l.h, '' order by l.pos) filter (l.pos > w.pos), ''))
         end as now
  from {name}{k} w join {level}{k} l on l.tree = w.tree and l.pos // 8 = w.pos // 8
  group by w.row_no, w.tree, w.pos)"""

    steps += [join_up("level", k) for k in range(levels)]
    steps.append(f"""
top0 as materialized (
  select '' as tree, row_number() over (order by tree) - 1 as pos, h, count(*) over () as n,
         tree as lang_tree
  from level{levels})""")
    steps += [join_up("top", k) for k in range(top_levels)]
    steps.append("""
walk0 as materialized (
  select row_number() over () as row_no, tree, pos, '' as proof,
         case when tampered then lowered else leaf end as now, doc_id, leaf
  from placed)""")
    steps += [climb("walk", "level", k) for k in range(levels)]
    steps.append(f"""
rise0 as materialized (
  select w.row_no, '' as tree, t.pos, w.proof, w.now
  from walk{levels} w join top0 t on t.lang_tree = w.tree)""")
    steps += [climb("rise", "top", k) for k in range(top_levels)]
    return ",".join(steps) + f"""
select d.doc_id, d.leaf, t.h as subroot, r.h as root, sha256(w.proof) as proof_sha256,
       w.now as folded_root, w.now = r.h as verified
from walk0 d join rise{top_levels} w using (row_no) join top0 t on t.lang_tree = d.tree
cross join top{top_levels} r
"""


OP12_SQL = r"""
with recursive worded as (
  select d.*, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         min(doc_id) over (partition by coalesce(text, '')) as first_id
  from documents d),
marked as (
  select doc_id, max((quality is not distinct from 1)::int) as good,
         max((toxic is not distinct from 1)::int) as toxic
  from labels where doc_id is not null group by doc_id),
failed as (
  select coalesce(lang, '') as part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         (case when len(w) < 200 then 'A' else '' end) ||
         (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end) ||
         (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 'C' else '' end) ||
         (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end) ||
         (case when doc_id > first_id or (doc_id is null and first_id is not null) then 'E' else '' end)
           as fails
  from worded left join marked using (doc_id)),
masks as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter),
orders(filter_order) as (
  select ''
  union all
  select filter_order || letter from orders join letters on not contains(filter_order, letter)),
steps as (
  select filter_order, step, filter_order[step:step] as filter, filter_order[1:step - 1] as before
  from orders, range(1, 6) r(step) where length(filter_order) = 5),
found as (
  select part, filter_order, step, filter,
         sum(n) filter (early = '' and not contains(fails, filter)) as kept,
         sum(n) filter (early = '' and contains(fails, filter)) as removed,
         sum(n) filter (early <> '' and contains(fails, filter)) as redundant,
         sum(n) filter (fails = filter) as unique_fails,
         sum(good) filter (early = '' and contains(fails, filter)) as good_lost,
         sum(toxic) filter (early = '' and contains(fails, filter)) as toxic_lost
  from (select *, case when before = '' then '' else regexp_replace(fails, '[^' || before || ']', '', 'g') end as early
        from steps, masks)
  group by part, filter_order, step, filter)
select part, filter_order, step::int as step, coalesce(kept, 0)::bigint as kept,
       coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant,
       coalesce(unique_fails, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost,
       coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, filter), 0)::bigint as shapley
from found
"""

ORACLES: dict[str, str] = {
    "op2_mix": OP2_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op4_near_dedup": OP4_SQL,
    "op10_archives": OP10_SQL,
    "op11_manifest": op11_sql(),
    "op12_filter_audit": OP12_SQL,
}
