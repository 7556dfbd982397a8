"""DuckDB SQL of those queries of this subpackage that SQL can express, written on its own: grouped
windows and joins where Spark uses expressions over arrays, sketches or matrix products."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"

NEAR_DEDUP = rf"""
with recursive w as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from documents),
s as (
  select r, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g
  from w),
d as (select distinct r, g from s),
n as (select r, count(*) as n from d group by r),
c as (select r, n, md5(string_agg(g, chr(10) order by g)) as h from d join n using (r) group by r, n),
k as (select h, any_value(n) as n, min(r) as r from c group by h),
e as (select d.* from d join k using (r)),
p as (select a.r as x, b.r as y, count(*) as shared from e a join e b on a.g = b.g and a.r < b.r group by a.r, b.r),
l as (
  select x, y from p join k i on p.x = i.r join k j on p.y = j.r where 100 * shared >= 75 * (i.n + j.n - shared)
  union select min(k.r), c.r from c join k on c.h = k.h group by c.r),
t as (select x, y from l union select y, x from l),
reach(a, b) as (select x, x from t union select reach.a, t.y from reach join t on reach.b = t.x),
m as (select a as r, min(doc_id) as component_id from reach join w on reach.b = w.r group by a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m.component_id, w.doc_id) as component_id,
       coalesce(w.doc_id = coalesce(m.component_id, w.doc_id), true) as kept
from w left join n using (r) left join m using (r)
"""

QUALITY_RULES = rf"""
with t as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '{WORD}') as w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
g as (
  select r, unnest(range(1, len(w) - 3)) as i,
         unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) as g from w where len(w) >= 5),
f as (select r, i from (select *, count(*) over (partition by r, g) as c from g) where c > 1),
e as (select r, count(distinct i + k) as n from f, range(5) x(k) group by r),
c as (
  select w.r, doc_id, lang, cast(len(w) as bigint) as n_words,
         cast(length(array_to_string(w, '')) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
         cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
         coalesce(e.n, 0) as n_repeat_words, len(l) as n_lines,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) as n_capitals
  from w left join e using (r)),
v as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
         case when n_words > 0 then n_symbols / n_words else 0 end as symbols,
         case when n_words > 0 then n_repeat_words / n_words else 0 end as repeats,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_lines,
         case when word_chars > 0 then n_capitals / word_chars else 0 end as capitals
  from c),
u as (unpivot v on symbols, repeats, dup_lines, capitals into name rule value x),
cuts as (select unnest([0.02, 0.03, 0.05, 0.07, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95])::double as cutoff),
y as (select doc_id, min(quality) = 1 as good from labels where quality is not null and doc_id is not null group by doc_id),
j as (
  select lang, rule, cutoff, count(*) filter (good) as n, count(*) filter (good and x > cutoff) as k,
         count(*) filter (not good and x > cutoff) as bad
  from u join y using (doc_id), cuts where not base_failed group by lang, rule, cutoff),
a as (
  select *, case when k <= n * 0.0125 then list_sum(list_transform(range(0, k + 1), lambda i: exp(
           lgamma(n + 1) - (case when i = 0 then 0 else lgamma(i + 1) end)
           - (case when i = n then 0 else lgamma(n - i + 1) end) + i * ln(0.0125) + (n - i) * ln(0.9875)))) else 1 end as p
  from j),
q as (
  select lang, rule, cutoff from (
    select *, row_number() over (partition by lang, rule order by bad - 10 * k desc, cutoff desc) as place
    from a where p <= 0.05 / ((select count(distinct coalesce('=' || lang, '')) from j) * 64) and bad > 10 * k)
  where place = 1),
b as (
  select r, string_agg(rule, ',' order by list_position(['symbols', 'repeats', 'dup_lines', 'capitals'], rule)) as reasons
  from u join q using (rule) where u.lang is not distinct from q.lang and x > q.cutoff group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and reasons is null as kept, coalesce(reasons, '') as rejected_by
from v left join b using (r)
"""

_TWO = ("'co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp', 'ne.jp', "
        "'or.jp', 'com.br', 'com.cn', 'com.mx', 'com.tr', 'co.in', 'co.kr', 'co.za'")


def _weight(groups: str) -> str:
    return f"""(
  select 1 / greatest(1e-4, least(0.99, coalesce(
    (sum(pow(x - n * m, 2) / n) - sum(m * (1 - m))) / nullif(sum(n * m * (1 - m)) - sum(m * (1 - m)), 0), 0.99))) - 1
  from {groups} where n > 0)"""


def _rule(host: str, path: str) -> str:
    return f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}'))"


URL_FILTER = rf"""
with a as (
  select *, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
b as (
  select page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from a),
c as (
  select *, string_split(host, '.') as part,
         regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
                        '<[^>]*>', ' ', 'g'), '&[a-z]+;', ' ', 'g') as body from b),
d as (
  select *, len(regexp_extract_all(body, '{WORD}')) as n_words,
         length(regexp_replace(body, '[^#*$%&|]+', '', 'g')) as signs,
         array_to_string(part[-2:], '.') in ({_TWO}) as deep from c),
e as (
  select *, array_to_string(case when deep then part[-3:] else part[-2:] end, '.') as domain,
         array_to_string(case when deep then part[-2:] else part[-1:] end, '.') as suffix,
         n_words < 10 or 10 * signs > n_words as bad from d),
h as (
  select host, domain, suffix, count(bad) as n, count(*) filter (bad) as x from e group by host, domain, suffix),
g1 as (
  select suffix, sum(n) as n, sum(x) as x, (select (sum(x) + 0.5) / (sum(n) + 1.0) from h) as m from h group by suffix),
s as (select suffix, (w * m + x) / (w + n) as up from g1, (select {_weight('g1')} as w)),
g2 as (select domain, suffix, sum(n) as n, sum(x) as x, any_value(s.up) as m from h join s using (suffix)
       group by domain, suffix),
o as (select domain, suffix, (w * m + x) / (w + n) as up from g2, (select {_weight('g2')} as w)),
g3 as (select host, n, x, o.up as m from h join o using (domain, suffix)),
z as (
  select host, mean - 1.645 * sqrt(mean * (1 - mean) / (w + n + 1)) as bound
  from (select host, n, w, (w * m + x) / (w + n) as mean from g3, (select {_weight('g3')} as w)))
select page_id, host, path,
  case when {_rule('example.net', '/en/')} then 'example.net/en/' when {_rule('example.com', '/de/')} then 'example.com/de/'
       when {_rule('org', '/fr/')} then 'org/fr/' when {_rule('net', '/')} then 'net/' end as rule,
  case when {_rule('example.net', '/en/')} then 'allow' when {_rule('example.com', '/de/')} then 'block'
       when {_rule('org', '/fr/')} then 'allow' when {_rule('net', '/')} then 'block'
       when bound > 0.2 then 'block' else 'allow' end as verdict
from e join z using (host)
"""

EXACT_TOPK = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""

SPELLING_VARIANTS = rf"""
with recursive steps as (
  select i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) as c
  from range(256) r(i)),
bits as (select list(c order by i) as t from steps),
found as (
  select coalesce(cast(doc_id as varchar), '') as id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]{{7,}}')) as run from documents),
runs as (select run, hex(encode(id || ':' || run)) as x, count(*) as k from found group by id, run),
sums as (
  select run, k, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda p: cast('0x' || substr(x, p, 2) as bigint))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as h from runs, bits),
drawn as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, k
  from sums),
words as (select word, cast(sum(k) as bigint) as n from drawn where length(word) >= 7 group by word having sum(k) >= 2),
less as (select word, i, substr(word, 1, i) || substr(word, i + 2) as d from words, range(length(word)) r(i)),
near as (
  select a.word, b.word as other from less a join less b on a.d = b.d and a.i = b.i and a.word <> b.word
  union select less.word, words.word from less join words on d = words.word
  union select words.word, less.word from less join words on d = words.word),
best as (
  select near.word, count(*) as n_near, arg_min(other, (-o.n, other)) as other, max(o.n) as other_n
  from near join words o on other = o.word group by near.word),
formed as (
  select word, n, coalesce(n_near, 0) as n_near, case when other_n >= 10 * n then other end as form,
         case when other_n >= 10 * n then other_n end as form_n from words left join best using (word)),
chain(word, root, steps) as (
  select word, word, 0 from words
  union all select chain.word, form, steps + 1 from chain join formed on chain.root = formed.word where form is not null)
select word, form, root, n, n_near, form_n from formed
join (select word, arg_max(chain.root, steps) as root from chain group by word) using (word)
"""

SQL: dict[str, str] = {
    "op2_near_dedup": NEAR_DEDUP,
    "op3_quality_rules": QUALITY_RULES,
    "op7_url_filter": URL_FILTER,
    "op9_exact_topk": EXACT_TOPK,
    "op11_spelling_variants": SPELLING_VARIANTS,
}
