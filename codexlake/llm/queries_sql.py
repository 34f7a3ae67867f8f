"""DuckDB SQL for the queries that SQL can express."""

OP2 = r"""
with dw as (
  select doc_id, row_number() over () as rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
wins as (
  select distinct item_id, least(10, len(w)) as k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') as win
  from iw, lateral (select unnest(generate_series(1, greatest(1, len(w) - 9))) as i) where len(w) > 0),
placed as (
  select rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
  from (select rid, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from dw, (select distinct k from wins) where len(w) >= k)),
hits as (select distinct rid, i, placed.k, item_id from placed join wins on placed.k = wins.k and placed.win = wins.win),
words as (select rid, count(distinct p) as n from (select rid, unnest(generate_series(i, i + k - 1)) as p from (select distinct rid, i, k from hits)) group by rid),
items as (select rid, count(distinct item_id) as n, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hits group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(items.n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from dw left join words using (rid) left join items using (rid)
"""

OP3 = r"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
g as (select *, max(page_id) over (partition by b) as keeper, octet_length(b) >= 1000 as large from p),
r as (select *, large and keeper is not null and page_id is distinct from keeper as again from g)
select page_id, cast(octet_length(b) as bigint) as payload_bytes, sha1(b) as payload_digest, case when again then 'revisit' else 'response' end as record_type, case when again then keeper end as refers_to from r
"""

_SOURCES = r"""
sized as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
s0 as (select source, sum(size)::bigint as source_size from sized group by source),
s1 as (select *, (row_number() over (order by source is null, encode(source)) - 1) % 3 + 1 as w, 3 * source_size as cap from s0),
s2 as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, source is null, encode(source) rows between unbounded preceding and 1 preceding), 0))::double / sum(w) over (order by cap / w, source is null, encode(source) rows between current row and unbounded following) as lev from s1),
s3 as (select *, max(case when lev <= cap / w then lev end) over () as level from s2),
t as (select source, source_size, least(cap::double, level * w) as target from s3)
"""


def _pass(n: int) -> str:
    """One pass of the sample over rows with room and open."""
    return f"""
m{n} as (select *, case when open and size <= room then size else 0 end as mass from r{n}),
c{n} as (select *, sum(mass) over (partition by source order by coalesce(rank / (1 + rank), 2), rank, doc_id, size rows unbounded preceding) as run from m{n}),
p{n} as (select *, open and size <= room and run <= room as now from c{n}),
r{n + 1} as (select doc_id, source, size, source_size, target, whole, rank, picked or now as picked, open and not now as open, room - sum(case when now then size else 0 end) over (partition by source) as room from p{n})"""


OP5 = (
    "with "
    + _SOURCES
    + r""",
e as (select doc_id, sized.source, size, source_size, target, case when source_size > 0 then least(target / source_size, 3.0::double) else 0.0::double end as mean, (('0x' || substr(md5('mix' || coalesce(cast(doc_id as varchar), '')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as u from sized join t on sized.source is not distinct from t.source),
r0 as (select doc_id, source, size, source_size, target, floor(mean) as whole, case when mean > floor(mean) then u / (1 - u) * ((1 - (mean - floor(mean))) / (mean - floor(mean))) end as rank, false as picked, mean > floor(mean) as open, target - sum(floor(mean) * size) over (partition by source) as room from e),"""
    + ",".join(_pass(n) for n in range(5))
    + " select doc_id, size, source_size, target, ((whole + case when picked then 1 else 0 end) * size)::bigint as taken from r5"
)

OP7 = r"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select rid, i, array_to_string(list_slice(w, i, i + 4), ' ') as s from (select rid, w, unnest(generate_series(1, len(w) - 4)) as i from d where len(w) >= 5)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, s) as n from win) where n > 1),
rep as (select rid, count(distinct p) as n from (select rid, unnest(generate_series(i, i + 4)) as p from twice) group by rid),
lines as (select rid, l from (select rid, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '[^\x20\x09-\x0D]')),
dups as (select rid, count(*) - count(distinct l) as n from lines group by rid),
m as (select rid, doc_id, source, len(w)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(dups.n, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words from d left join rep using (rid) left join dups using (rid)),
f as (select *, (n_words < 10)::int as f1, (100 * n_repeat_words > 20 * n_words)::int as f2, (10 * n_symbols > 3 * n_words)::int as f3, (2 * n_dup_lines > 1 + n_words::double / 10)::int as f4 from m),
h as (select source, count(*) as n, sum(f1) as k1, sum(f2) as k2, sum(f3) as k3, sum(f4) as k4 from f group by source),
r as (select source, n, rule, k from h, lateral (select unnest(['1', '2', '3', '4']) as rule, unnest([k1, k2, k3, k4]) as k)),
p as (select rule, avg(k / n) as mu, var_pop(k / n) as v from r group by rule),
q as (select source, max(case when (k + mu * st) / (n + st) > 0.6 then 1 else 0 end) = 1 as bad from (select r.source, r.k, r.n, p.mu, greatest(1.0, case when v > 0 then mu * (1 - mu) / v - 1 else 1e6 end) as st from r join p using (rule)) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 = 1 or f2 = 1) as base_failed, not (f1 = 1 or f2 = 1) and not bad as kept from f join q on f.source is not distinct from q.source
"""

OP10 = r"""
with recursive d as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sh as (select distinct rid, doc_id, array_to_string(list_slice(w, i, i + least(4, len(w)) - 1), ' ') as s from (select rid, doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) as i from d where len(w) > 0)),
n as (select rid, doc_id, count(*) as n from sh group by rid, doc_id),
common as (select a.rid as ra, b.rid as rb, count(*) as k from sh a join sh b on a.s = b.s and a.rid < b.rid group by a.rid, b.rid),
link as (select x.doc_id as a, y.doc_id as b from common join n x on x.rid = ra join n y on y.rid = rb where 100 * k >= 80 * (x.n + y.n - k)),
edge as (select a, b from link union select b, a from link),
walk as (select doc_id as a, doc_id as b from documents union select walk.a, edge.b from walk join edge on walk.b = edge.a),
comp as (select a, min(b) as c from walk group by a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, comp.c as component_id, d.doc_id = comp.c as kept from d left join n using (rid) join comp on comp.a = d.doc_id
"""

OP9 = r"""
with d as (select row_number() over () as rid, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select rid, i, md5(substr(h, 2 * i + 1, 400)) as m from (select rid, h, unnest(range(0, length(h) // 2 - 199)) as i from d where length(h) >= 400)),
rep as (select rid, i from (select rid, i, count(*) over (partition by m) as n from w) where n > 1),
runs as (select rid, i, sum(case when i <= before + 200 then 0 else 1 end) over (partition by rid order by i) as g from (select rid, i, lag(i) over (partition by rid order by i) as before from rep)),
spans as (select rid, min(i) as lo, max(i) + 200 as hi from runs group by rid, g),
gaps as (select rid, coalesce(lag(hi) over (partition by rid order by lo), 0) as a, lo as b from spans union all select rid, max(hi), null from spans group by rid),
kept as (select rid, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' order by a) as k from gaps join d using (rid) group by rid),
sums as (select rid, sum(hi - lo) as n_removed, count(*) as n_spans from spans group by rid)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256 from d left join sums using (rid) left join kept using (rid)
"""

ORACLE = {"op2_decontamination": OP2, "op3_warc": OP3, "op5_mixing": OP5, "op7_quality_rules": OP7, "op9_suffix_dedup": OP9, "op10_minhash": OP10}
