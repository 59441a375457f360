"""DuckDB statements of the training-data queries that SQL can express.

The others are tested against brute force: scores of the language model, votes
and divergence rules, spans with terms, token ids, whitened vectors and neighbours.
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP6 = rf"""
with item as (select cast(item_id as varchar) item, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where item_id is not null),
 win as (select distinct item, l, array_to_string(w[k:k + l - 1], ' ') s from (select *, unnest(range(1, len(w) - l + 2)) k from (select *, least(13, len(w)) l from item where len(w) > 0))),
 doc as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
 place as (select doc_id, l, k, array_to_string(w[k:k + l - 1], ' ') s from (select *, unnest(range(1, len(w) - l + 2)) k from doc, (select distinct l from win) where len(w) >= l)),
 met as (select doc_id, l, k, item from place join win using (l, s)),
 hit as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(k, k + l)) p from met) group by 1),
 its as (select doc_id, count(distinct item) n, string_agg(distinct item, ',' order by item) s from met group by 1)
select doc_id, cast(len(w) as bigint) n_words, coalesce(hit.n, 0) n_hit, coalesce(its.n, 0) n_items, sha256(coalesce(its.s, '')) items_sha256, coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from doc left join hit using (doc_id) left join its using (doc_id)
"""

OP8 = r"""
with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size, md5(coalesce(cast(doc_id as varchar), '')) h from documents),
 s as (select source, sum(size) z, row_number() over (order by source nulls last) - 1 i from d group by 1),
 w as (select *, cast([5, 2, 1][i % 3 + 1] as double) w, z * 2.0e0 most from s),
 b as (select *, coalesce(sum(most) over (o rows between unbounded preceding and 1 preceding), 0) mb, coalesce(sum(w) over (o rows between unbounded preceding and 1 preceding), 0) wb, sum(z) over () * 1.5e0 t, sum(w) over () wt
       from w window o as (order by most / w, source nulls last)),
 c as (select *, (t - mb) * w >= most * (wt - wb) capped from b),
 g as (select source, z, case when capped then most else (t - sum(case when capped then most else 0 end) over ()) * w / sum(case when capped then 0 else w end) over () end target,
        cast(('0x' || substr(md5(concat('0:', coalesce('s' || source, ''))), 1, 5)) as bigint) / 1048576.0e0 u from c),
 r as (select *, case when z > 0 then target / z else 0.0e0 end r from g),
 j as (select d.doc_id, d.source, d.size, d.h, z, target, u, r, d.size * 50 > z big from d join r on d.source is not distinct from r.source),
 p as (select *, row_number() over (partition by source, big order by case when big then size else length(cast(size as varchar)) * 100 + cast(substr(cast(size as varchar), 1, 2) as int) end, h, doc_id) k from j),
 l as (select doc_id, source, size, z, target, least(floor(u + r * k) - floor(u + r * (k - 1)), 2) n from p where big),
 e as (select source, sum(size * n) done, sum(size) x, count(*) m from l group by 1),
 a as (select r.source, u + r * coalesce(m, 0) b, case when z - coalesce(x, 0) > 0 then greatest(0.0e0, least(2.0e0, (target - coalesce(done, 0)) / (z - coalesce(x, 0)))) else 0.0e0 end q from r left join e on r.source is not distinct from e.source),
 y as (select doc_id, size, z, target, n from l union all
       select doc_id, size, z, target, least(floor(b + q * k) - floor(b + q * (k - 1)), 2) n from p join a on p.source is not distinct from a.source where not big)
select doc_id, size, cast(z as bigint) source_size, target, cast(size * n as bigint) taken from y
"""

OP9 = """
with p as (select page_id, coalesce(html, '') h, sha256(coalesce(html, '')) d, strlen(coalesce(html, '')) n from pages),
 f as (select *, case when n >= 100 then min(page_id) over (partition by d) else page_id end f from p)
select page_id, cast(n as bigint) payload_bytes, d payload_digest, case when f = page_id then 'response' else 'revisit' end record_type, case when f <> page_id then f end refers_to from f
"""

OP10 = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x20\x09-\x0D]+') w from documents),
 sh as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') s from (select *, unnest(range(1, greatest(len(w) - 3, 2))) k from d where len(w) > 0)),
 n as (select doc_id, count(*) n from sh group by 1),
 pair as (select a.doc_id x, b.doc_id y, count(*) k from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
 link as (select x, y from pair join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 80 * (a.n + b.n - k)),
 reach as (select doc_id x, doc_id y from d union select r.x, l.y from reach r join link l on r.y = l.x)
select d.doc_id, coalesce(n.n, 0) n_shingles, c.m component_id from d left join n using (doc_id) join (select x, min(y) m from reach group by 1) c on c.x = d.doc_id
"""

OP5 = r"""
with t as (select doc_id, string_split(text, chr(10)) s from documents where text is not null),
 l as (select doc_id, pos, regexp_extract_all(lower(s[pos]), '[^\x20\x09-\x0D]+') w from (select *, unnest(range(1, len(s) + 1)) pos from t)),
 k as (select doc_id, pos, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' ')))) sh from l where len(w) > 0),
 f as (select sh, min((doc_id, pos)) f, row_number() over () id from k group by sh),
 x as (select id, f, len(sh) n, unnest(sh) g from f),
 m as (select a.id from x a join x b on a.g = b.g and b.f < a.f group by a.id, b.id having 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
 c as (select doc_id, count(*) n, count(*) filter (where (doc_id, pos) <> f.f) e, count(*) filter (where (doc_id, pos) = f.f and f.id in (select id from m)) s from k join f using (sh) group by 1)
select d.doc_id, coalesce(n, 0) n_lines, coalesce(e, 0) n_equal, coalesce(s, 0) n_similar from (select distinct doc_id from documents) d left join c using (doc_id)
"""

OP11 = r"""
with t as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t from documents),
 w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w, min(doc_id) over (partition by t) least from t),
 f as (select doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] f from w),
 l as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels where doc_id is not null group by 1),
 c as (select part, f, count(*) n, sum(coalesce(good, 0)) good, sum(coalesce(toxic, 0)) toxic from f left join l using (doc_id) group by 1, 2),
 i as (select unnest(range(1, 6)) i),
 o as (select [a.i, b.i, c.i, d.i, e.i] o from i a, i b, i c, i d, i e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
 s as (select c.part, o.o, i.i step, o.o[i.i] own,
        sum(case when list_bool_or(list_transform(o.o[1:i.i], lambda k: f[k])) then 0 else n end) kept,
        sum(case when f[o.o[i.i]] and not coalesce(list_bool_or(list_transform(o.o[1:i.i - 1], lambda k: f[k])), false) then n else 0 end) removed,
        sum(case when f[o.o[i.i]] and coalesce(list_bool_or(list_transform(o.o[1:i.i - 1], lambda k: f[k])), false) then n else 0 end) redundant,
        sum(case when f[o.o[i.i]] and len(list_filter(f, lambda x: x)) = 1 then n else 0 end) unique_fails,
        sum(case when f[o.o[i.i]] and not coalesce(list_bool_or(list_transform(o.o[1:i.i - 1], lambda k: f[k])), false) then good else 0 end) good_lost,
        sum(case when f[o.o[i.i]] and not coalesce(list_bool_or(list_transform(o.o[1:i.i - 1], lambda k: f[k])), false) then toxic else 0 end) toxic_lost
       from c, o, i group by 1, 2, 3, 4)
select part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k, 1)), '') filter_order, cast(step as int) step, cast(kept as bigint) kept, cast(removed as bigint) removed, cast(redundant as bigint) redundant,
       cast(unique_fails as bigint) unique_fails, cast(good_lost as bigint) good_lost, cast(toxic_lost as bigint) toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) shapley from s
"""

ORACLES: dict[str, str] = {"op5_line_dedup": OP5, "op6_decontaminate": OP6, "op8_mixing": OP8, "op9_warc": OP9, "op10_ngram_jaccard": OP10, "op11_filter_interactions": OP11}
