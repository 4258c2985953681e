"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = f"""
with parted as (
  select page_id, url, instr(url, '://') as sep from pages
), rest as (
  select page_id, case when sep > 0 then substr(url, sep + 3) else '' end as rest from parted
), places as (
  select page_id,
    {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from rest
), rules as (
  select * from (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) t(rule_host, rule_path, verdict)
), places_once as (
  select distinct host, path from places
), best as (
  select p.host, p.path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(verdict, length(rule_host || rule_path)) as verdict
  from places_once p join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host))
   and starts_with(p.path, r.rule_path)
  group by 1, 2
)
select page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') as verdict
from places p left join best b on p.host = b.host and p.path = b.path
"""

_WORDS = f"list_filter(regexp_split_to_array({_LOWER.format('text')}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP5 = f"""
with items as (
  select item_id, {_WORDS} as ws from benchmark where text is not null
), docs as (
  select doc_id, {_WORDS} as ws from documents where text is not null
), item_shingles as (
  select distinct item_id, unnest(list_transform(range(1, len(ws) - 3),
    lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) as shingle
  from items where len(ws) >= 5
), sizes as (
  select item_id, count(*) as n_item from item_shingles group by 1
), doc_shingles as (
  select distinct doc_id, unnest(list_transform(range(1, len(ws) - 3),
    lambda i: array_to_string(list_slice(ws, i, i + 4), ' '))) as shingle
  from docs where len(ws) >= 5
)
select doc_id, item_id, count(*) as n_shared, any_value(n_item) as n_item,
  count(*) / any_value(n_item) as containment
from doc_shingles join item_shingles using (shingle) join sizes using (item_id)
group by doc_id, item_id having count(*) >= 0.8 * any_value(n_item)
"""

OP13 = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: floor(256 * c::double)) as x
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
    list_dot_product(a.x, r.x)::bigint as score
  from usable a join usable r on a.vec_id <> r.vec_id
  where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
  (row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id))::integer as rank,
  n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n
  on n.anchor_id = p.anchor_id and not n.same
 and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
qualify rank <= 5
"""

ORACLES = {"op5_decontamination": OP5, "op6_url_filter": OP6, "op13_hard_negatives": OP13}
