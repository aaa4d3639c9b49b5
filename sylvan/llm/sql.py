"""DuckDB SQL for the queries that SQL can state."""

#: The line key: ASCII white space cut at both ends, A-Z lower-cased.
_KEY = ("translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
        "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

LINE_DEDUP = f"""
with d as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select r, doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from d),
k as (select *, {_KEY} as key from l),
often as (select key from k where length(key) >= 1 group by key having count(distinct r) >= 10)
select k.doc_id, count(*)::bigint as n_lines, count(o.key)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where o.key is null), '')) as kept_sha256
from k left join often o on k.key = o.key group by k.r, k.doc_id
"""

#: CRC-32 of a text's bytes from the 256-entry table its polynomial gives.
_CRC = """
crc_table as (
  select list(v order by i) as t from (
    select i, list_reduce(list_prepend(i::bigint, range(8)),
                          lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) as g(i))
),
bytes as (
  select r, list_transform(range(1, length(h) // 2 + 1),
                           lambda i: ('0x' || substr(h, (2 * i - 1)::bigint, 2))::bigint) as b
  from (select r, hex(encode(body)) as h from d)
),
crcs as (
  select r, xor(list_reduce(list_prepend(4294967295::bigint, b),
                            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32
  from bytes, crc_table
)"""

#: Jump consistent hashing: the generator in 128-bit integers, one recursion step a jump.
SHARDING = f"""
with recursive d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body, octet_length(encode(coalesce(text, ''))) + 1 as size,
         (coalesce(doc_id, 0)::hugeint + 18446744073709551616::hugeint) % 18446744073709551616::hugeint as k0
  from documents
), jumps(n, k0, k, b, j) as (
  select t.n, k0, k0, (-1)::bigint, 0::bigint from (select distinct k0 from d), (values (16), (17)) as t(n)
  union all
  select n, k0, next, j, floor((j + 1)::double * (2147483648.0::double / ((next // 8589934592) + 1)::double))::bigint
  from (select *, (k * 2862933555777941757::hugeint + 1) % 18446744073709551616::hugeint as next
        from jumps where j < n)
), ends as (select n, k0, max(b) as shard from jumps group by n, k0),
{_CRC}
select d.doc_id, d.size::bigint as size, c.text_crc32::bigint as text_crc32, 'key' as law, s.shard::int as shard,
       (row_number() over (partition by s.shard order by d.doc_id nulls first, c.text_crc32, d.size) - 1)::bigint as slot,
       g.shard::int as grown_shard
from d join crcs c using (r) join ends s on s.k0 = d.k0 and s.n = 16 join ends g on g.k0 = d.k0 and g.n = 17
"""

#: All phrases of one to five words per language; a phrase goes if a one-word extension has its count
#: (a longer one of the same count would make every extension between them have it too).
COLLOCATIONS = r"""
with recursive p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) as piece
  from documents
), w as (select lang, regexp_extract_all(piece, '[^ \t]+') as ws from p),
total as (select lang, sum(len(ws))::hugeint as n from w group by lang),
g as (
  select lang, ws[i:i + k - 1] as ph, k
  from (select lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as i from w, range(1, 6) as t(k) where len(ws) >= k)
), f as (select lang, ph, k, count(*)::hugeint as a from g group by all having count(*) >= 100),
gone as (
  select lang, ph[:k - 1] as ph, a from f where k > 2 union all select lang, ph[2:] as ph, a from f where k > 2
), c as (
  select f.lang, f.ph, f.k, f.a, total.n from f join total using (lang)
  where f.k >= 2 and not exists (select 1 from gone where gone.lang = f.lang and gone.ph = f.ph and gone.a >= f.a)
), cuts as (
  select c.*, t.j, x.a as l, y.a as r, 1000::hugeint * c.a * c.n // (x.a * y.a) as score
  from (select c.*, unnest(range(1, c.k)) as j from c) as t
  join c on c.lang = t.lang and c.ph = t.ph
  join f x on x.lang = t.lang and x.ph = t.ph[:t.j]
  join f y on y.lang = t.lang and y.ph = t.ph[t.j + 1:]
), weakest as (
  select *, row_number() over (partition by lang, ph order by score, j) as place from cuts
), ranked as (
  select *, array_to_string(ph, ' ') as phrase from weakest where place = 1
)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score from (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from ranked
) where rank <= 2000
"""

FILTER_AUDIT = r"""
with recursive d as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as body from documents
), w as (select *, regexp_extract_all(body, '[^ \t-\r]+') as ws from d),
m as (
  select part, doc_id, [
    len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
    100 * (length(body) - length(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(body),
    regexp_matches(body, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) over (partition by body), false)] as fails from w
), l as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels where doc_id is not null group by doc_id
), c as (
  select part, fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, count(*) as n from m left join l using (doc_id) group by all
), orders(o) as (
  select '' union all select o || x from orders, (values ('A'), ('B'), ('C'), ('D'), ('E')) as t(x) where not contains(o, x)
), steps as (
  select o as filter_order, step::int as step, substr(o, step, 1) as f,
         list_transform(string_split(left(o, (step - 1)::bigint), ''), lambda x: ascii(x) - 64) as earlier
  from orders, range(1, 6) as t(step) where length(o) = 5
), states as (select distinct f, earlier from (select f, list_sort(earlier) as earlier from steps)),
sums as (
  select part, f, earlier,
    coalesce(sum(n) filter (where not early and not now), 0) as kept, coalesce(sum(n) filter (where now and not early), 0) as removed,
    coalesce(sum(n) filter (where now and early), 0) as redundant,
    coalesce(sum(n) filter (where now and len(list_filter(fails, lambda x: x)) = 1), 0) as unique_fails,
    coalesce(sum(n) filter (where now and not early and good = 1), 0) as good_lost,
    coalesce(sum(n) filter (where now and not early and toxic = 1), 0) as toxic_lost
  from (select c.*, f, earlier, fails[ascii(f) - 64] as now,
               len(list_filter(earlier, lambda i: i > 0 and fails[i])) > 0 as early from c, states)
  group by all
)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, s.f))::bigint as shapley
from steps s join sums on sums.f = s.f and sums.earlier = list_sort(s.earlier)
"""
