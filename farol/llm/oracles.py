"""DuckDB statements that the training-data queries must equal."""

from __future__ import annotations

from farol.llm import license_scan as L

_SPACE = r"[\x20\x09-\x0D]"

OP6 = rf"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') as ws
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as g
  from w),
n as (select doc_id, count(*) as n from sh group by 1),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (
  select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) as (
  select doc_id, doc_id from w union select r.doc_id, l.b from reach r join l on l.a = r.other)
select r.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.other) as component_id
from reach r left join n on n.doc_id = r.doc_id group by r.doc_id
"""

OP10 = rf"""
with d as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') as t from documents)
select doc_id, first_value(doc_id) over (partition by t order by n desc, doc_id) as keep_id,
  count(*) over (partition by t) as group_size,
  doc_id = first_value(doc_id) over (partition by t order by n desc, doc_id) as kept, sha256(t) as text_sha256
from d
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
ws as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from ws, (values (1), (2), (3)) as sizes(k) where len(w) >= k),
f as (select lang, k, phrase, lang || chr(9) || phrase as id, count(*) as f from grams group by all),
total as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, id, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
longer as (
  select lang || chr(9) || array_to_string(w[i:i + 1], ' ') as id, max(a) as most from c, (values (1), (2)) as start(i) where k = 3 group by all),
kept as (select c.* from c left join longer g on g.id = c.id where not (100 * coalesce(g.most, 0) >= 50 * c.a)),
halves as (
  select lang, phrase, a, j, lang || chr(9) || array_to_string(w[1:j], ' ') as x, lang || chr(9) || array_to_string(w[j + 1:], ' ') as y
  from kept, (values (1), (2)) as cut(j) where j < k),
known as materialized (select id, f from f),
firsts as materialized (select h.*, known.f as l from halves h join known on known.id = h.x),
cuts as (
  select h.*, known.f as r, ((1000000::hugeint * a * a) // (l::hugeint * known.f))::bigint as score from firsts h join known on known.id = h.y),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score
from ranked r join total t on t.lang = r.lang where r.rank <= 2000
"""


# Unsigned crc32 of a decimal number, one byte and one bit at a time.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}::varchar, ''), lambda x: ascii(x)::bigint)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))), 4294967295)"""

OP13 = rf"""
with own as (
  select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} order by turn nulls first) as turns
  from conversations where conv_id is not null group by conv_id),
h as (select conv_id, conv_id - conv_id % 20 as lead, ({_CRC.format('conv_id')} % 4)::int as h, turns from own),
seqs as (
  select h.conv_id, list_concat(coalesce(own.turns, [])[1:h.h], h.turns[h.h + 1:]) as s from h left join own on own.conv_id = h.lead),
prefixes as (select conv_id, s, unnest(range(0, len(s) + 1)) as depth from seqs),
nodes as (
  select s[1:depth] as path, depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(s) = depth), '')) as ends_sha256,
    coalesce(len(list_filter(regexp_split_to_array(any_value(s[depth].text), '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0) as words
  from prefixes group by s[1:depth], depth),
kids as (select path[1:depth - 1] as path, count(*) as n from nodes where depth > 0 group by 1),
told as (select nodes.*, coalesce(kids.n, 0) as n_children from nodes left join kids on kids.path = nodes.path),
above as (select path, unnest(range(0, depth + 1)) as up, (n_convs - 1) * words as saved, (n_children = 0)::int as leaf from told),
sums as (select path[1:up] as path, sum(leaf) as n_leaves, sum(saved) as saved from above group by 1)
select t.conv_id, t.depth, p.conv_id as parent_conv_id, t.n_convs, t.n_children, s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, t.ends_sha256
from told t join sums s on s.path = t.path left join told p on t.depth > 0 and p.path = t.path[1:t.depth - 1]
"""


def _op5() -> str:
    notices = ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(L.TEMPLATES))
    word, mention = L.WORD, L.MENTION.removeprefix("(?i)")
    return f"""
with f as (
  select doc_id, text, concat_ws('/', coalesce(source, 'unknown'), cast(floor(doc_id / 1000) as bigint), cast(floor(doc_id / 50) as bigint), doc_id) as path
  from documents),
notices(notice, licence, wording) as (values {notices}),
spec as (
  select notice, licence, term, count(*) as tf
  from (select notice, licence, unnest(regexp_extract_all(lower(wording), '{word}')) as term from notices) group by all),
total as (select count(*) as n from f),
df as (
  select term, count(*) as df from (select distinct doc_id, unnest(regexp_extract_all(lower(text), '{word}')) as term from f)
  where term in (select term from spec) group by 1),
idf as (
  select term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 as idf, ln(1 + n) + 1 as other
  from (select distinct term from spec) left join df using (term), total),
lines as (
  select distinct doc_id, line from (select doc_id, unnest(string_split(text, chr(10))) as line from f)
  where regexp_matches(line, '{mention}', 'i')),
tf as (
  select doc_id, line, term, count(*) as tf
  from (select doc_id, line, unnest(regexp_extract_all(lower(line), '{word}')) as term from lines) group by all),
w as (
  select doc_id, line, term, tf * coalesce(idf, (select max(other) from idf)) as w from tf left join idf using (term)),
norm as (select doc_id, line, sqrt(sum(w * w)) as l from w group by all),
v as (select notice, licence, term, tf * idf as w from spec join idf using (term)),
vn as (select notice, licence, sqrt(sum(w * w)) as l from v group by all),
dots as (select doc_id, line, notice, sum(w.w * v.w) as dot from w join v using (term) group by all),
best as (
  select doc_id, licence, round(dot / (norm.l * vn.l), 6) as score,
    row_number() over (partition by doc_id order by round(dot / (norm.l * vn.l), 6) desc, licence) as k
  from dots join norm using (doc_id, line) join vn using (notice)),
own as (
  select doc_id, path, regexp_replace(path, '/?[^/]*$', '') as leaf, licence, score
  from f left join (select * from best where k = 1 and score >= {L.OWN_SCORE}) using (doc_id)),
speaks as (
  select leaf as dir, arg_min(licence, path) as licence, arg_min(score, path) as score
  from own where score >= {L.FILE_SCORE} group by 1),
near as (
  select o.leaf, arg_max(s.licence, length(s.dir)) as d_licence, arg_max(s.score, length(s.dir)) as d_score
  from (select distinct leaf from own) o join speaks s on o.leaf = s.dir or starts_with(o.leaf, s.dir || '/') group by 1)
select doc_id, path, coalesce(licence, d_licence) as licence, coalesce(score, d_score) as score,
  case when licence is not null then 'own' when d_licence is not null then 'inherited' else 'none' end as origin
from own left join near using (leaf)
"""


def all_sql() -> dict[str, str]:
    return {"op5_license_scan": _op5(), "op6_jaccard_join": OP6, "op10_exact_dedup": OP10, "op12_collocations": OP12, "op13_conversation_trie": OP13}
