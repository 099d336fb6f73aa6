"""SQL for the queries that SQL can express, over the same tables."""

SQL = {}

SQL["op3_url_filter"] = r"""
with parts as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') as path
  from pages),
canonical as (
  select *, host || case
    when path like '%.html' then left(path, length(path) - 5)
    when path like '%/' then left(path, length(path) - 1)
    else path end as canonical
  from parts),
listed as (
  select distinct canonical from canonical
  where host like '%ads-track%' or host like '%casino-win%' or host like '%spam-farm%'),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and path like '/en/%'
      then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%'
      then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/'
    end as rule
  from canonical)
select page_id, host, path, rule, case
    when rule in ('example.net/en/', 'org/fr/') then 'allow'
    when rule in ('example.com/de/', 'net/') then 'block'
    when host <> '' and canonical in (select canonical from listed) then 'block'
    else 'allow' end as verdict
from ruled
"""

SQL["op8_mixing"] = r"""
with recursive sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5('8:' || coalesce(doc_id::varchar, '')), 1, 12))::bigint as hash
  from documents),
sums as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (
  select source, source_size, 3 * source_size as most,
    [5, 2, 1][((row_number() over (order by source collate "C" asc nulls last) - 1) % 3 + 1)::int]
      as weight
  from sums),
-- Sources fill in the order of most / weight: full ones are a prefix of that order.
ordered as (
  select *, row_number() over (order by most::double / weight, source) as place,
    coalesce(sum(most) over (order by most::double / weight, source
      rows between unbounded preceding and 1 preceding), 0)::bigint as used,
    (sum(weight) over (order by most::double / weight desc, source desc))::bigint as open_weight,
    (sum(source_size) over ())::bigint as total
  from ranked),
level as (
  select min(place) as place from ordered
  where weight * (total - used) < most * open_weight),
targets as (
  select o.source, o.source_size,
    case when l.place is null or o.place < l.place then o.most::double
      else o.weight::double * (e.total - e.used)::double / e.open_weight::double end as target
  from ordered o, level l left join ordered e on e.place = l.place),
rooms as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as repeats
  from targets),
along as (
  select s.*, r.source_size, r.target, r.repeats::bigint as repeats,
    r.target - r.repeats * r.source_size as room,
    (sum(size) over (partition by s.source order by hash))::bigint as upto,
    (sum(size) over (partition by s.source, hash))::bigint as words
  from sized s join rooms r on s.source is not distinct from r.source),
fit as (
  select *, upto <= room
    or (room - (upto - words) > 0 and upto - room < room - (upto - words)) as fits
  from along)
select doc_id, size, source_size, target,
  size * least(repeats + (case when fits then 1 else 0 end), 3) as taken
from fit
"""

SQL["op6_topk"] = """
with whole as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
vectors as (select *, row_number() over (partition by vec_id order by v) as copy from whole),
scored as (
  select q.vec_id as query_id, q.copy, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v),
      lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::bigint as score
  from vectors q join vectors c
    on q.vec_id % 50 = 0 and (q.vec_id <> c.vec_id or q.copy <> c.copy)),
ranked as (
  select *, row_number() over (partition by query_id, copy order by score desc, vec_id)::int as rank
  from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

SQL["op12_reverse_search"] = r"""
with folded as (
  select doc_id, row_number() over () as row,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
sized as (select row, doc_id, len(terms)::bigint as n, terms from folded where len(terms) > 0),
whole as (select count(*)::bigint as docs, sum(n)::bigint as words from sized),
counts as (
  select row, term, count(*)::bigint as tf
  from (select row, unnest(terms) as term from sized) group by row, term),
held as (select term, count(*)::bigint as df from counts group by term),
items as (
  select item_id, text as item, term, count(*)::bigint as uses
  from (select distinct item_id, text, unnest(range(len(found))) as place, found[place + 1] as term
    from (select item_id, text, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as found from benchmark))
  group by item_id, text, term),
weighed as (
  select i.*, floor(1000 * ln((2 * w.docs + 2)::double / (2 * h.df + 1)::double))::bigint as weight
  from items i join held h using (term) cross join whole w),
scored as (
  select i.item_id, i.item, c.row, sum(i.uses * i.weight * ((1000000000 * c.tf)
    // (1000 * c.tf + 8 * (100 - 75 + (75 * s.n * w.docs) // w.words))))::bigint as score
  from weighed i join counts c using (term) join sized s using (row) cross join whole w
  group by i.item_id, i.item, c.row),
ranked as (
  select item_id, item, doc_id, score, (row_number() over (partition by item_id, item
    order by score desc, doc_id nulls last, row))::int as rank
  from scored join sized using (row) where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""

SQL["op13_fill_middle"] = r"""
with drawn as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(doc_id::varchar, '')) as digest
  from documents),
cut as (
  select doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') as tokens,
    ('0x' || substr(digest, 1, 8))::bigint as h1, ('0x' || substr(digest, 9, 8))::bigint as h2,
    ('0x' || substr(digest, 17, 8))::bigint as h3, ('0x' || substr(digest, 25, 8))::bigint as h4
  from drawn),
places as (
  select *, len(tokens)::bigint as n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as first,
    greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) as second,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
      or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from cut),
parts as (
  select *, array_to_string(tokens[1:first], '') as prefix,
    array_to_string(tokens[first + 1:second], '') as middle,
    array_to_string(tokens[second + 1:], '') as suffix
  from places)
select doc_id, n, form,
  case when form <> 'plain' then length(prefix) end as prefix_chars,
  case when form <> 'plain' then length(middle) end as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""
