"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from opsledger.llm import bpe, chaining, covertree, extract, interactions, multiindex, packing, quality, sharding, simhash, suffix, warc, whitening

QUERIES = {
    f.__name__: f
    for f in (
        chaining.op1_substring_dedup, suffix.op2_suffix_dedup, quality.op3_quality_rules, sharding.op4_sharding, warc.op5_warc, packing.op6_packing, covertree.op7_embedding_dedup, bpe.op8_bpe, extract.op9_html, simhash.op10_simhash_dedup,
        interactions.op11_filter_audit, whitening.op12_whitening, multiindex.op13_multi_index,
    )
}

# where SQL says the whole result; the others have brute-force tests
CHECKS = {
    "op5_warc": """select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha1(html) as payload_digest, case when r then 'revisit' else 'response' end as record_type, case when r then most end as refers_to
 from (select *, octet_length(encode(html)) >= 1000 and page_id is distinct from most and most is not null as r from (select page_id, html, max(page_id) over (partition by html) as most from (select page_id, coalesce(html, '') as html from pages) p) m) q""",
    "op7_embedding_dedup": """with recursive v as (select row_number() over () as row, vec_id, label, cast(embedding as double[]) as x from embeddings),
 good as (select * from v where label is not null and len(x) > 0 and len(list_filter(x, lambda e: e is null or isnan(e) or isinf(e))) = 0 and len(list_filter(x, lambda e: e <> 0)) > 0),
 links as (select a.row as a, b.row as b from good a join good b on a.label = b.label and len(a.x) = len(b.x) and a.row <> b.row where case when len(a.x) = len(b.x) then list_cosine_similarity(a.x, b.x) else 0 end >= 0.93),
 reached as (select row, row as other from v union select r.row, l.b from reached r join links l on l.a = r.other)
 select v.vec_id, coalesce(n.n, 0) as n_links, c.component_id, v.vec_id is not distinct from c.component_id as kept from v left join (select a, count(*) as n from links group by a) n on n.a = v.row
 join (select r.row, min(o.vec_id) as component_id from reached r join v o on o.row = r.other group by r.row) c on c.row = v.row""",
    "op11_filter_audit": """with recursive w as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') as words from documents),
 f as (select part, doc_id, len(words) < 100 as a, 100 * len(list_distinct(words)) < 80 * len(words) as b, 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) as c,
  regexp_matches(text, '[#$%&*|]') as d, coalesce(min(doc_id) over (partition by text) < doc_id, false) as e from w),
 l as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
 fails as (select part, [a, b, c, d, e] as fail, coalesce(good, false) as good, coalesce(toxic, false) as toxic from f left join l using (doc_id)),
 counted as (select part, fail, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from fails group by part, fail),
 orders as (select '' as o union all select o || x from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) letters where instr(o, x) = 0),
 steps as (select o, s, ascii(o[s]) - 64 as own, [ascii(x) - 64 for x in string_split(o[:s - 1], '') if x <> ''] as earlier from orders, (select unnest([1, 2, 3, 4, 5]) as s) numbers where length(o) = 5),
 told as (select part, o, s, own, n, good, toxic, fail[own] as hit, len([x for x in earlier if fail[x]]) > 0 as gone, len([x for x in fail if x]) = 1 as lone from counted, steps),
 summed as (select part, o, s, own, sum(case when not hit and not gone then n else 0 end) as kept, sum(case when hit and not gone then n else 0 end) as removed, sum(case when hit and gone then n else 0 end) as redundant,
  sum(case when hit and lone then n else 0 end) as unique_fails, sum(case when hit and not gone then good else 0 end) as good_lost, sum(case when hit and not gone then toxic else 0 end) as toxic_lost from told group by part, o, s, own)
select part, o as filter_order, cast(s as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
 cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley from summed""",
}
