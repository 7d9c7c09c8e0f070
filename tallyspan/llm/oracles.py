"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from tallyspan.llm.licenses import LICENSE_FILE, SIMILARITY, TEMPLATES

DECONTAMINATION = r"""
with d as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
b as (
  select item_id,
         regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null),
item_windows as (
  select item_id, least(len(w), 10) as size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as k, w
  from b where len(w) > 0),
windows as (
  select distinct item_id, size, array_to_string(list_slice(w, k, k + size - 1), ' ') as line
  from item_windows),
places as (
  select r, size, unnest(range(1, len(w) - size + 2)) as k, w
  from d, (select distinct size from windows) where len(w) >= size),
hits as (
  select p.r, p.k, p.size, x.item_id
  from places p join windows x
    on x.size = p.size and x.line = array_to_string(list_slice(p.w, p.k, p.k + p.size - 1), ' ')),
words as (
  select r, count(distinct word) as n_hit
  from (select r, unnest(range(k, k + size)) as word from hits) group by r),
items as (
  select r, count(distinct item_id) as n_items,
         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as names
  from hits group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""

SUBSTRINGS = r"""
with d as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents),
windows as (
  select doc_id, k, array_to_string(list_slice(w, k, k + 12), ' ') as line
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as k from d where len(w) >= 13)),
firsts as (select line, min(doc_id) as first from windows group by line),
gone as (
  select distinct doc_id, unnest(range(k, k + 13)) as place
  from windows join firsts using (line) where first < doc_id),
words as (
  select doc_id, unnest(range(1, len(w) + 1)) as place, unnest(w) as word from d),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by place) as line
  from words anti join gone using (doc_id, place) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(line, '')) as kept_sha256
from d left join kept using (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LICENSES = r"""
with templates(number, license, text) as (values {templates}),
files as (
  select doc_id as file_id, text,
    case when doc_id % 1000 < 20 then (doc_id // 1000) || '/LICENSE'
         when doc_id % 25 = 0 then (doc_id // 1000) || '/' || source || '/LICENSE.txt'
         else (doc_id // 1000) || '/' || source || '/' || doc_id || '.txt' end as path
  from documents),
template_terms as (
  select number, license, term, count(*) as n
  from (select number, license, unnest(regexp_extract_all(lower(text), '[\pL\pN]+')) as term
        from templates) group by all),
frequency as (
  select term, count(*) as df
  from (select unnest(list_distinct(regexp_extract_all(lower(text), '[\pL\pN]+'))) as term
        from files) where term in (select term from template_terms) group by term),
total as (select count(*) as n from files),
weights as (
  select term, ln((1 + n) / (1 + coalesce(df, 0))) + 1 as weight
  from (select distinct term from template_terms) left join frequency using (term), total),
vectors as (
  select number, license, term, n * weight / sqrt(sum((n * weight) ** 2) over (partition by number))
    as part
  from template_terms join weights using (term)),
lines as (
  select distinct file_id, line from (
    select file_id, unnest(string_split(text, chr(10))) as line from files
    union all
    select file_id, text from files
    where regexp_matches(lower(string_split(path, '/')[-1]), '{license_file}'))),
terms as (
  select file_id, line, term, count(*) as n
  from (select file_id, line, unnest(regexp_extract_all(lower(line), '[\pL\pN]+')) as term from lines)
  group by all),
weighed as (
  select file_id, line, term, t.n * coalesce(weight, ln(1 + total.n) + 1) as w
  from terms t left join weights using (term), total),
norms as (select file_id, line, sqrt(sum(w * w)) as norm from weighed group by all),
dots as (
  select file_id, line, number, license, sum(w * part) as dot
  from weighed join vectors using (term) group by all),
scored as (
  select file_id, license, round(dot / norm, 6) as score
  from dots join norms using (file_id, line) where round(dot / norm, 6) >= {similarity}),
own as (
  select file_id, license as own, score as own_score from scored
  qualify row_number() over (partition by file_id order by score desc, license) = 1),
placed as (
  select f.file_id, f.path, own, own_score, string_split(f.path, '/') as parts
  from files f left join own using (file_id)),
directories as (
  select array_to_string(parts[:-2], '/') as dir, own, own_score from placed
  where own is not null and regexp_matches(lower(parts[-1]), '{license_file}')
  qualify row_number() over (
    partition by array_to_string(parts[:-2], '/') order by own_score desc, own, path) = 1),
above as (
  select file_id, unnest(range(0, len(parts))) as depth, parts from placed),
nearest as (
  select file_id, d.own, d.own_score, d.dir
  from above join directories d on d.dir = array_to_string(parts[:depth], '/')
  qualify row_number() over (partition by file_id order by depth desc) = 1)
select p.file_id, p.path, coalesce(p.own, n.own) as license,
       coalesce(p.own_score, n.own_score) as score,
       case when p.own is not null then 'text' when n.dir is not null then 'directory' end as origin,
       case when p.own is null then n.dir end as from_dir
from placed p left join nearest n using (file_id)
"""

LICENSES = (
    _LICENSES.replace("{templates}", ", ".join(
        f"({k}, {_quoted(name)}, {_quoted(text)})" for k, (name, text) in enumerate(TEMPLATES)
    ))
    .replace("{license_file}", LICENSE_FILE)
    .replace("{similarity}", str(SIMILARITY))
)

MERKLE = r"""
with recursive
marked as (
  select *, list_reduce(
      list_concat([4294967295::bigint],
                  list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
      lambda a, b: list_reduce(
        [xor(a, b), 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint, 0::bigint,
         0::bigint],
        lambda c, z: xor(c >> 1, (3988292384 * (c & 1))::bigint) + z)) as crc,
    row_number() over () as row,
    sha256({fields} || {text}) as leaf,
    sha256({fields} || {without}) as less
  from (select *, replace(text, chr(10), '') as joined from documents)),
leaves as (
  select doc_id, leaf, case when xor(crc, 4294967295::bigint) % 2 = 0 then less else leaf end as given,
    dense_rank() over (order by source nulls first) - 1 as tree,
    row_number() over (partition by source order by doc_id nulls first, leaf, row) - 1 as pos
  from marked),
trees as (
  select tree, 0 as level, list(leaf order by pos) as l from leaves group by tree
  union all
  select tree, level + 1, list_transform(range(0, (len(l) + 2) // 3),
                                         lambda i: sha256(array_to_string(l[3 * i + 1 : 3 * i + 3], '')))
  from trees where len(l) > 1),
subroots as (select tree, l[1] as subroot from trees where len(l) = 1),
tops as (
  select 0 as level, list(subroot order by tree) as l from subroots
  union all
  select level + 1, list_transform(range(0, (len(l) + 2) // 3),
                                   lambda i: sha256(array_to_string(l[3 * i + 1 : 3 * i + 3], '')))
  from tops where len(l) > 1),
places as (
  select tree, pos, level, l, pos // (3 ** level)::bigint as i from leaves join trees using (tree)
  where len(l) > 1
  union all
  select x.tree, x.pos, 1000 + level, l, x.tree // (3 ** level)::bigint from leaves x, tops where len(l) > 1),
steps as (
  select tree, pos, level, array_to_string(l[i // 3 * 3 + 1 : i], '') as l,
         array_to_string(l[i + 2 : i // 3 * 3 + 3], '') as r
  from places),
paths as (
  select tree, pos, list({'l': l, 'r': r} order by level) as path,
         string_agg(l || r, '' order by level) as siblings
  from steps group by tree, pos),
folded as (
  select doc_id, leaf, subroot, (select l[1] from tops where len(l) = 1) as root,
         sha256(coalesce(siblings, '')) as proof_sha256,
         list_reduce(
           list_concat([{'l': given, 'r': ''}], coalesce(path, [])),
           lambda a, s: {'l': sha256(s.l || a.l || s.r), 'r': ''}).l as folded_root
  from leaves join subroots using (tree) left join paths using (tree, pos))
select *, folded_root = root as verified from folded
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::varchar)::varchar || ':' || {name}::varchar, '-')"


MERKLE = (
    MERKLE.replace("{fields}", " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars"])))
    .replace("{text}", _field("text")).replace("{without}", _field("joined"))
)


HARD_NEGATIVES = r"""
with rows as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
         list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a is distinct from b and len(a.v) = len(b.v)
  where a.vec_id % 50 = 0),
positives as (
  select anchor_id, other as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, other))::int as rank,
       other as negative_id, positive_score, score as negative_score
from positives join pairs using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, other) <= 3
"""
