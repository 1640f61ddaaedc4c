"""DuckDB equivalents of the operators that SQL can express."""

#: Base32 of a SHA-1: five hexadecimal digits hold four of its characters.
OP2_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select *, sha1(h) as x, max(page_id) over (partition by h) as keeper from p)
select page_id, strlen(h) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (i // 4) * 5 + 1, 5))::bigint >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
  case when page_id = keeper then 'response' else 'revisit' end as record_type, case when page_id <> keeper then keeper end as refers_to
from d"""

#: crc32 goes bit by bit over the decimal digits; trees grow level by level, a language's and then the one over their roots.
OP11_SQL = """
with recursive
raw as (
  select row_number() over () as r, doc_id, lang, n_chars,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as tail, doc_id::varchar as digits
  from documents),
hit as (
  select r, xor(list_reduce(list_concat([4294967295::bigint],
      list_transform(range(8 * length(digits)), lambda k: (ascii(substr(digits, (k // 8 + 1)::integer, 1)) >> (k % 8)::integer)::bigint & 1)),
    lambda c, b: xor(c >> 1, 3988292384::bigint * (xor(c, b) & 1))), 4294967295::bigint) % 7 = 0 as yes
  from raw),
hashed as (
  select doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
    case when yes and digits is not null and n_chars is not null then sha256(head || strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1) || tail) end as changed
  from raw join hit using (r)),
leaves as (
  select *, coalesce('s' || lang, 'n') as tree, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n from hashed),
nodes as (
  select tree, 0 as level, i, n, leaf as h from leaves
  union all
  select tree, level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by i)) from nodes where n > 1 group by tree, level, i // 2),
subroots as (select tree, h as subroot, row_number() over (order by tree collate "binary") - 1 as t, count(*) over () as trees from nodes where n = 1),
tops as (
  select 0 as level, t as i, trees as n, subroot as h from subroots
  union all
  select level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by i)) from tops where n > 1 group by level, i // 2),
root as (select h as root from tops where n = 1),
steps as (select tree, level, any_value(n) as n from nodes where n > 1 group by tree, level),
top_steps as (select level, any_value(n) as n from tops where n > 1 group by level),
beside as (
  select l.tree, l.i, 0 as part, s.level, case when x.h is null then '' when (l.i >> s.level::integer) & 1 = 1 then '<' || x.h else '>' || x.h end as h
  from leaves l join steps s using (tree) left join nodes x on x.tree = l.tree and x.level = s.level and x.i = xor(l.i >> s.level::integer, 1)
  union all
  select l.tree, l.i, 1, s.level, case when x.h is null then '' when (u.t >> s.level::integer) & 1 = 1 then '<' || x.h else '>' || x.h end
  from leaves l join subroots u using (tree) cross join top_steps s left join tops x on x.level = s.level and x.i = xor(u.t >> s.level::integer, 1)),
paths as (select tree, i, list(h order by part, level) as path from beside group by tree, i),
folded as (
  select l.*, u.subroot, coalesce(p.path, []) as path,
    list_reduce(list_concat([coalesce(l.changed, l.leaf)], coalesce(p.path, [])),
      lambda a, b: case when b = '' then sha256(a) when b[1] = '<' then sha256(b[2:] || a) else sha256(a || b[2:]) end) as folded_root
  from leaves l join subroots u using (tree) left join paths p on p.tree = l.tree and p.i = l.i)
select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda b: b[2:]), '')) as proof_sha256, folded_root, folded_root = root as verified
from folded, root"""

OP12_SQL = r"""
with d as (select row_number() over () as r, doc_id, text from documents),
q as (select row_number() over () as r, item_id, text from benchmark),
found as (
  select r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) as term from d),
asked as (
  select r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) as term from q),
tf as (select r, doc_id, term, count(*) as tf from found group by all),
lengths as (select r, sum(tf)::bigint as n from tf group by r),
totals as (select count(*) as documents, sum(n)::bigint as total from lengths),
measures as (select r, 25 + (75 * n * documents) // total as m from lengths, totals),
weights as (select term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::bigint as w from tf, totals group by term, documents),
scores as (
  select a.r, a.item_id, t.r as d, t.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked a join weights using (term) join tf t using (term) join measures x on x.r = t.r group by a.r, a.item_id, t.r, t.doc_id),
ranked as (select *, row_number() over (partition by r order by score desc, doc_id nulls first) as rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10"""

OP13_SQL = """
with recursive
e as (
  select row_number() over () as r, vec_id,
    case when vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 then embedding::double[] end as v
  from embeddings),
links as (
  select a.r as a, b.r as b, b.vec_id as vec_id from e a join e b on a.r <> b.r and len(a.v) = len(b.v)
  where case when len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) >= 0.9 else false end),
reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select reach.a, min(e.vec_id) as vec_id from reach join e on e.r = reach.b group by reach.a),
counted as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n, 0) as n_links, least(e.vec_id, coalesce(least.vec_id, e.vec_id)) as component_id, e.vec_id is not distinct from least(e.vec_id, coalesce(least.vec_id, e.vec_id)) as kept
from e left join least on least.a = e.r left join counted on counted.a = e.r"""
