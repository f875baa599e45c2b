"""The same results in DuckDB SQL, for the queries that SQL can express."""

# words: runs of anything but space and U+0009-U+000D; lines: parts between line feeds
_QUALITY = r"""
with base as (
  select doc_id, lang, source, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
grams as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select doc_id, w, unnest(generate_series(1, len(w) - 2)) as i from base where len(w) >= 3) x),
twice as (select doc_id, g from grams group by doc_id, g having count(*) > 1),
covered as (
  select doc_id, count(distinct p) as n_repeat_words
  from (select g.doc_id, unnest([g.i, g.i + 1, g.i + 2]) as p from grams g join twice using (doc_id, g)) x group by doc_id),
m as (
  select b.doc_id, lang, source, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, len(l) as n_lines
  from base b left join covered c using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
v as (
  select doc_id, lang, source, r.rule as rule, r.low as low,
         cast(floor(case r.rule when 'symbols' then 1000 * sqrt(n_symbols) / sqrt(n_words)
                    when 'dup_lines' then 1000 * sqrt(n_dup_lines) / sqrt(n_lines)
                    when 'repeats' then 1000 * sqrt(n_repeat_words) / sqrt(n_words)
                    else 1000 * word_chars / n_words end) as bigint) as val,
         cast(floor(case r.rule when 'symbols' then 1000 * greatest(sqrt(n_symbols) - 2, 0.0e0) / sqrt(n_words)
                    when 'dup_lines' then 1000 * greatest(sqrt(n_dup_lines) - 2, 0.0e0) / sqrt(n_lines)
                    when 'repeats' then 1000 * greatest(sqrt(n_repeat_words) - 2, 0.0e0) / sqrt(n_words)
                    else 1000 * word_chars / n_words end) as bigint) as least
  from f, (values ('symbols', false), ('dup_lines', false), ('repeats', false), ('long_words', false), ('short_words', true)) r(rule, low)
  where not base_failed),
c as (
  select *, (val >> greatest(0, length(bin(val)) - 6)) << greatest(0, length(bin(val)) - 6) as cell,
         (least >> greatest(0, length(bin(least)) - 6)) << greatest(0, length(bin(least)) - 6) as least_cell
  from v),
sg as (select lang, source, rule, cell, cast(count(*) as hugeint) as n from c group by all),
sl as (select lang, rule, cell, cast(count(*) as hugeint) as n from c group by all),
sa as (select rule, cell, cast(count(*) as hugeint) as n from c group by all),
rl as (select lang, rule, cast(count(*) as hugeint) as n from c group by all),
ra as (select rule, cast(count(*) as hugeint) as n from c group by all),
gr as (select distinct lang, source, rule, low from c),
w as (
  select lang, source, rule, cell, sum(w) as w from (
    select g.lang, g.source, g.rule, g.cell, g.n * ra.n * (rl.n + 200) as w from sg g join rl on g.rule = rl.rule and g.lang is not distinct from rl.lang join ra on g.rule = ra.rule
    union all
    select gr.lang, gr.source, gr.rule, sl.cell, 200 * ra.n * sl.n from gr join sl on gr.rule = sl.rule and gr.lang is not distinct from sl.lang join ra on gr.rule = ra.rule
    union all
    select gr.lang, gr.source, gr.rule, sa.cell, cast(40000 as hugeint) * sa.n from gr join sa on gr.rule = sa.rule) x
  group by all),
u as (select *, sum(w) over (partition by lang, source, rule order by cell) as upto, sum(w) over (partition by lang, source, rule) as total from w),
q as (
  select lang, source, rule, min(case when 1000 * upto >= 100 * total then cell end) as q10, min(case when 1000 * upto >= 500 * total then cell end) as q50,
         min(case when 1000 * upto >= 900 * total then cell end) as q90
  from u group by all),
pick as (
  select gr.lang, gr.source, gr.rule, case when low then q10 - 4 * (q50 - q10) else q90 + 4 * (q90 - q50) end as bound
  from q join gr on q.rule = gr.rule and q.lang is not distinct from gr.lang and q.source is not distinct from gr.source),
bad as (
  select v.doc_id from c v join pick p on v.rule = p.rule and v.lang is not distinct from p.lang and v.source is not distinct from p.source
  where case when v.low then v.least_cell < p.bound else v.least_cell > p.bound end group by v.doc_id)
select f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and bad.doc_id is null as kept
from f left join bad on f.doc_id = bad.doc_id
"""

_LINES = r"""
with l as (
  select doc_id, i, x, translate(regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents) s),
often as (select k, max(doc_id) as last from l where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
j as (select l.doc_id, l.i, l.x, o.k is not null and l.doc_id <> o.last as gone from l left join often o on l.k = o.k)
select doc_id, count(*) as n_lines, cast(sum(case when gone then 1 else 0 end) as bigint) as n_dropped,
       sha256(coalesce(string_agg(x, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from j group by doc_id
"""

_VECTORS = """
with recursive e as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as a, b.vec_id as b from e a join e b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
r as (select vec_id, vec_id as m from embeddings union select r.vec_id, l.b from r join l on r.m = l.a),
c as (select vec_id, min(m) as component_id from r group by vec_id),
n as (select a, count(*) as n from l group by a)
select c.vec_id, coalesce(n, 0) as n_links, component_id, c.vec_id = component_id as kept from c left join n on n.a = c.vec_id
"""

# terms: runs of letters a-z (A-Z folded) and of characters beyond ASCII
_DIVERGENCE = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
g as (select distinct lang, source from d),
o as (select doc, lang, source, unnest(regexp_extract_all(t, '[a-z\x{80}-\x{10FFFF}]+')) as term from d),
k as (select lang, term, cast(count(*) as hugeint) as lang_n from o group by lang, term having count(distinct doc) >= 10),
n as (select lang, source, term, cast(count(*) as hugeint) as n from o group by all),
v as (select lang, cast(count(*) as hugeint) as v, sum(lang_n) as lang_total from k group by lang),
c as (
  select g.lang, g.source, k.term, coalesce(n.n, 0) as n, k.lang_n
  from g join k using (lang) left join n on n.lang = g.lang and n.source = g.source and n.term = k.term),
s as (select lang, source, sum(n) as total from c group by all),
p as (
  select c.lang, c.source, c.term, c.n, 1 + (1000000000 * (c.n + 2)) // (s.total + 2 * v.v) as p, 1 + (1000000000 * (c.lang_n + 2)) // (v.lang_total + 2 * v.v) as q
  from c join s using (lang, source) join v using (lang)),
pr as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join pr on pr.lang = a.lang and pr.source = a.source and pr.item = b.source),
terms as (select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value from p where n > 0 and p > q),
r as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from terms) x)
select lang, source, part, item, value, cast(rank as integer) as rank from r where part = 'pair' or rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_source_divergence": _DIVERGENCE, "op3_quality_rules": _QUALITY, "op7_embedding_near_dedup": _VECTORS, "op8_line_dedup": _LINES}
