"""Check SQL for DuckDB, with its own constants."""

OP2 = r"""
with d as (select doc_id, lang, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
common as (select unnest(['the','of','and','to','in','that','is','for','with','as','on','by','it','was','are','be','this','from','die','der','und','den','das','von','mit','zu','ist','im','des','dem','nicht','ein','eine','auf','für','de','la','le','les','et','en','que','pour','dans','un','une','du','par','sur','pas','il','el','los','se','las','por','con','una','su','para','al','y','no']) as word),
windows as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as s from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, s) as n from windows) where n > 1),
covered as (select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
lines as (select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
base as (
  select w.doc_id, lang, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    length(regexp_replace(t, '[^a-z]', '', 'g')) as c0, length(regexp_replace(t, '[^A-Z]', '', 'g')) as c1, length(regexp_replace(t, '[^0-9]', '', 'g')) as c2,
    length(regexp_replace(t, '[^.,;:?''"()\-]', '', 'g')) as c3, length(regexp_replace(t, '[^!]', '', 'g')) as c4, length(regexp_replace(t, '[[:ascii:]]', '', 'g')) as c6,
    length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) as c7, length(t) as total
  from w join lines using (doc_id) left join covered using (doc_id)
),
flagged as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words >= 80 and word_chars >= 200 as long_enough from base),
classes as (
  select doc_id, lang, long_enough, b.k as bin, b.c / total::double as x from flagged, lateral (select unnest([
    {'k': 0, 'c': c0}, {'k': 1, 'c': c1}, {'k': 2, 'c': c2}, {'k': 3, 'c': c3}, {'k': 4, 'c': c4}, {'k': 5, 'c': n_symbols}, {'k': 6, 'c': c6}, {'k': 7, 'c': c7},
    {'k': 8, 'c': total - c0 - c1 - c2 - c3 - c4 - n_symbols - c6 - c7}]) as b) where n_words > 0
),
found as (select doc_id, coalesce(c.word, '*') as bin, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) as word from d) x left join common c using (word) group by all),
words as (
  select f.doc_id, f.lang, f.long_enough, b.bin, coalesce(found.n, 0) / f.n_words::double as x
  from flagged f cross join (select word as bin from common union all select '*') b left join found on found.doc_id = f.doc_id and found.bin = b.bin where f.n_words > 0
),
class_sums as (select lang, bin, sum(x) as s, count(*) as n from classes where long_enough group by all),
word_sums as (select lang, bin, sum(x) as s, count(*) as n from words where long_enough group by all),
class_means as (select lang, bin, s / n as y from class_sums where lang is not null and n >= 20),
word_means as (select lang, bin, s / n as y from word_sums where lang is not null and n >= 20),
class_distances as (
  select doc_id, sqrt(greatest(0, sum(case when x > 0 then x * log2(2 * x / (x + y)) else 0 end + case when y > 0 then y * log2(2 * y / (x + y)) else 0 end) / 2)) as class_distance
  from classes c join class_means m using (lang, bin) group by doc_id
),
word_distances as (
  select doc_id, sqrt(greatest(0, sum(case when x > 0 then x * log2(2 * x / (x + y)) else 0 end + case when y > 0 then y * log2(2 * y / (x + y)) else 0 end) / 2)) as word_distance
  from words c join word_means m using (lang, bin) group by doc_id
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (
    (word_chars >= 200 and coalesce(class_distance > 0.30, false)) or (n_words >= 80 and coalesce(word_distance > 0.55, false))
    or (word_chars >= 200 and n_words >= 80 and coalesce(class_distance > 0.12 and word_distance > 0.24, false))) as kept,
  round(class_distance, 6) as class_distance, round(word_distance, 6) as word_distance
from flagged left join class_distances using (doc_id) left join word_distances using (doc_id)
"""

OP3 = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
n as (select doc_id, h, length(h) // 2 as n_bytes from d),
w as (select doc_id, p, md5(substr(h, 2 * p + 1, 200)) as k from (select doc_id, h, unnest(range(0, n_bytes - 99)) as p from n)),
late as (select doc_id, p from (select doc_id, p, row_number() over (partition by k order by doc_id, p) as r from w) where r > 1),
islands as (select doc_id, p, sum(case when gap then 1 else 0 end) over (partition by doc_id order by p) as island
  from (select doc_id, p, coalesce(p > lag(p) over (partition by doc_id order by p) + 100, true) as gap from late)),
spans as (select doc_id, island, min(p) as a, max(p) + 100 as b from islands group by all),
cuts as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from spans),
kept as (select doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as rest, sum(b - a)::bigint as n_removed, count(*) as n_spans
  from cuts join n using (doc_id) group by doc_id)
select doc_id, n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
from n left join kept using (doc_id)
"""

OP4 = r"""
with doc as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
item as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from benchmark),
ds as (select doc_id, i - 1 as pos, len(ws) as n, array_to_string(ws[i:i + 4], ' ') as s from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from doc)),
its as (select item_id, i - 1 as pos_in_item, len(ws) as l, array_to_string(ws[i:i + 4], ' ') as s from (select item_id, ws, unnest(range(1, len(ws) - 3)) as i from item)),
win as (select distinct doc_id, item_id, l, greatest(0, least(pos - pos_in_item, n - l)) as start from ds join its using (s)),
have as (select doc_id, item_id, l, start, s, count(*) as c from win join ds using (doc_id) where pos >= start and pos <= greatest(start + l - 5, start) group by all),
want as (select item_id, s, count(*) as c from its group by all),
held as (select h.doc_id, h.item_id, h.l, h.start, sum(case when w.c is null then 0 else least(h.c, w.c) * length(replace(h.s, ' ', '')) end) as common, sum(h.c * length(replace(h.s, ' ', ''))) as total
  from have h left join want w using (item_id, s) group by all),
sized as (select item_id, sum(c * length(replace(s, ' ', ''))) as total from want group by all),
good as (select doc_id, item_id, l, start, common / (b.total + z.total - common)::double as similarity from held b join sized z using (item_id) where 100 * common >= 80 * (b.total + z.total - common)),
best as (select *, row_number() over (partition by doc_id, item_id order by similarity desc, start, l desc) as r from good)
select doc_id, item_id, round(similarity, 6) as similarity, start::bigint as start, l::bigint as n_words from best where r = 1
"""

OP7 = r"""
with sized as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from s),
leveled as (select *, 2 * source_size::double / weight as level, (sum(source_size) over ())::double * 150 / 100 as volume from weighed),
filled as (select *, coalesce(sum(2 * source_size) over (order by level, source nulls last rows between unbounded preceding and 1 preceding), 0)::double as below,
  (sum(weight) over (order by level, source nulls last rows between current row and unbounded following))::double as open_weight from leveled),
shared as (select *, max(case when (volume - below) / open_weight <= level then (volume - below) / open_weight end) over () as common from filled),
targets as (select source, source_size, case when source_size = 0 then 0 when common is null or level < common then 2 * source_size::double else common * weight end as target from shared),
placed as (select doc_id, z.source, size, source_size, target,
  row_number() over (partition by z.source order by size, md5(coalesce(doc_id::varchar, 'null') || ':7'), doc_id) as place,
  ('0x' || substr(md5(coalesce(z.source, '') || ':7'), 1, 5))::bigint / 1048576::double as shift
  from sized z join targets t on z.source is not distinct from t.source),
stepped as (select *, case when source_size > 0 then target / source_size else 0 end as step from placed)
select doc_id, size, source_size, target, size * least(2, (floor(shift + step * place) - floor(shift + step * (place - 1)))::bigint) as taken from stepped
"""

OP9 = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sh as (
  select distinct doc_id, array_to_string(ws[i:i + 2], ' ') as s from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
  union all select doc_id, array_to_string(ws, ' ') from w where len(ws) in (1, 2)
),
n as (select doc_id, count(*) as n from sh group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
low as (select a as doc_id, min(b) as low from reach group by a),
degree as (select a as doc_id, count(*) as n_links from links group by a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(low.low, w.doc_id)) as component_id, coalesce(n_links, 0) as n_links
from w left join n using (doc_id) left join low using (doc_id) left join degree using (doc_id)
"""

OP11 = r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
g as (select lang, source, term, count(*) as n, count(distinct id) as d from (select lang, source, id, unnest(ws) as term from d) group by all),
kept as (select lang, term, sum(n) as total from g group by all having sum(d) >= 3),
whole as (select lang, count(*) as v, sum(total) as t from kept group by lang),
own as (select g.lang, source, term, n from g join kept using (lang, term)),
groups as (select lang, source, coalesce(sum(n), 0) as t from (select distinct lang, source from d) left join own using (lang, source) group by all),
p as (select x.lang, x.source, k.term, coalesce(o.n, 0) as n, 1 + 1000000000::hugeint * (coalesce(o.n, 0) + 1) // (x.t + w.v) as p, 1 + 1000000000::hugeint * (k.total + 1) // (w.t + w.v) as q
  from groups x join whole w using (lang) join kept k using (lang) left join own o on o.lang = x.lang and o.source = x.source and o.term = k.term),
far as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join far f on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value from p where n > 0 and p > q)
select * from (select *, (row_number() over (partition by lang, source, part order by value desc, encode(item)))::int as rank from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 200
"""

OP12 = r"""
with recursive crc as (select list(c order by i) as tab from (
  select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c from (select unnest(range(256)) as i))),
keyed as (select conv_id, coalesce('=' || conv_id, '') as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
  from conversations),
hit as (select *, xor(4294967295::bigint, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(k, ''), lambda x: ord(x)::bigint)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 20 as hit from keyed, crc),
damaged as (select conv, turn, case when hit = 4 then 'user' else role end as role, case hit when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(case when hit = 3 then [0, 1] else [0] end) as copy from hit where hit <> 0)),
placed as (select *, row_number() over (partition by conv order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as pos,
  count(*) over (partition by conv) as n, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as t from damaged),
judged as (select *, left(role, 1) as x, case when t = '' then 'blank' when row_number() over (partition by conv, role, text order by pos) > 1 then 'duplicate' when right(t, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from placed),
costed as (select *, fault in ('', 'truncated') as can, case when fault = 'truncated' then 3 else 0 end as more from judged),
back as (
  select conv, max(n) + 1 as pos, 0 as d0, 6 as d1, 3 as d2, 0 as d3 from costed group by conv
  union all
  select conv, pos, least(b0, 3 + b2, 6 + b3), least(b1, 3 + b2, 6 + b3), least(b2, 3 + b3), least(b3, 3 + b2) from (
    select r.conv, r.pos,
      least(4 + d0, case when can and x = 's' then more + d1 when can and x = 'u' then more + d2 end, case when can then more + 3 + d2 end) as b0,
      least(4 + d1, case when can and x = 'u' then more + d2 end, case when can then more + 3 + d2 end) as b1,
      least(4 + d2, case when can and x = 'a' then more + d3 end, case when can then more + 3 + d3 end) as b2,
      least(4 + d3, case when can and x = 'u' then more + d2 end, case when can then more + 3 + d2 end) as b3
    from back b join costed r on r.conv = b.conv and r.pos = b.pos - 1)
),
vec as (select conv, pos, [d0, d1, d2, d3] as v from back),
walk as (
  select conv, 1::bigint as pos, 0 as q, '' as audit, []::varchar[] as lines from costed where pos = 1
  union all
  select conv, pos + case when e = 'I' then 0 else 1 end,
    case when e = 'D' then q when e = 'K' and x = 's' then 1 when q = 2 then 3 else 2 end,
    audit || e,
    case e when 'D' then lines when 'K' then list_append(lines, role || ':' || text)
      else list_append(lines, case when q = 2 then 'assistant:' else 'user:' end || case when e = 'R' then text else '' end) end
  from (
    select w.*, r.x, r.role, r.text, case
      when r.pos is null then 'I'
      when 4 + n.v[q + 1] = c.v[q + 1] then 'D'
      when 3 + c.v[case when q = 2 then 3 else 2 end + 1] = c.v[q + 1] then 'I'
      when can and x = 's' and q = 0 and more + n.v[2] = c.v[q + 1] then 'K'
      when can and x = 'u' and q <> 2 and more + n.v[3] = c.v[q + 1] then 'K'
      when can and x = 'a' and q = 2 and more + n.v[4] = c.v[q + 1] then 'K'
      else 'R' end as e
    from walk w join vec c on c.conv = w.conv and c.pos = w.pos left join vec n on n.conv = w.conv and n.pos = w.pos + 1 left join costed r on r.conv = w.conv and r.pos = w.pos
    where r.pos is not null or q in (1, 2))
),
ends as (select w.conv, audit, sha256(array_to_string(lines, chr(10))) as sha from walk w join (select conv, max(n) + 1 as pos from costed group by conv) using (conv, pos) where q in (0, 3)),
counts as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(fault = 'blank') as blank, count_if(fault = 'duplicate') as duplicate, count_if(fault = 'truncated') as truncated,
  count_if(pos > 1 and before || x not in ('su', 'ua', 'au')) as illegal from (select *, coalesce(lag(x) over (partition by conv order by pos), '') as before from costed) group by conv),
ids as (select conv, any_value(conv_id) as conv_id from keyed group by conv)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
  coalesce(v[1], 0)::bigint as cost, coalesce(audit, '') as audit, coalesce(sha, 'e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855') as repaired_sha256
from ids left join counts using (conv) left join ends using (conv) left join (select conv, v from vec where pos = 1) using (conv)
"""
