"""DuckDB text for the operators on windows, sets and vectors, by the definition instead of the method."""

WS = r"[\x20\x09-\x0D]+"

_REACH = """reach as (select a as id, a as to_id from nodes union select r.id, l.b from reach r join links l on r.to_id = l.a)"""

SUBSTRING_DEDUP = f"""with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> '') as ws from documents),
  win as (select doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) as k from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
  firsts as (select k, min(doc_id) as f from win group by k),
  repeated as (select doc_id, i from win join firsts using (k) where f < doc_id),
  gone as (select distinct doc_id, i + j as p from repeated, (select unnest(range(50)) as j)),
  words as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from w),
  kept as (select doc_id, count(*) filter (g.p is not null) as n_removed, string_agg(word, ' ' order by x.p) filter (g.p is null) as t from words x left join gone g using (doc_id, p) group by doc_id)
  select w.doc_id, len(w.ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from w left join kept using (doc_id)"""

NGRAM_JACCARD = f"""with recursive w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '{WS}'), lambda x: x <> '') as ws from documents),
  sh as (select distinct doc_id, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: md5(array_to_string(ws[i:i + 4], ' '))) when len(ws) > 0 then [md5(array_to_string(ws, ' '))] else [] end) as g from w),
  size as (select doc_id, count(*) as n from sh group by doc_id),
  common as (select x.doc_id as a, y.doc_id as b, count(*) as c from sh x join sh y on x.g = y.g and x.doc_id <> y.doc_id group by all),
  links as (select a, b, c = s.n and c = t.n as same from common join size s on s.doc_id = a join size t on t.doc_id = b where c >= 0.8 * (s.n + t.n - c)),
  nodes as (select doc_id as a from documents), {_REACH},
  class as (select id, min(to_id) as class_id from reach group by id)
  select d.doc_id, c.class_id, least(d.doc_id, coalesce((select min(b) from links l where l.a = d.doc_id and l.same), d.doc_id)) as copy_of,
    (select count(*) from links l where l.a = d.doc_id) as n_links, c.class_id = d.doc_id as kept from documents d join class c on c.id = d.doc_id"""

EMBEDDING_DEDUP = f"""with recursive v as (select vec_id, label, x, sqrt(list_sum(list_transform(x, lambda c: c * c))) as n from (select vec_id, label, list_transform(embedding, lambda c: c::double) as x from embeddings)
    where label is not null and x is not null and len(list_filter(x, lambda c: c is null or isnan(c) or isinf(c))) = 0),
  links as (select p.vec_id as a, q.vec_id as b from v p join v q on p.label = q.label and p.vec_id <> q.vec_id and p.n > 0 and q.n > 0 and len(p.x) = len(q.x) where list_dot_product(p.x, q.x) / p.n / q.n >= 0.93),
  nodes as (select vec_id as a from embeddings), {_REACH},
  class as (select id, min(to_id) as component_id from reach group by id)
  select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links, c.component_id, c.component_id = e.vec_id as kept from embeddings e join class c on c.id = e.vec_id"""
