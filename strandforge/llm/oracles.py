"""SQL forms of the training-data queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from . import line_dedup

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAMS = f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array({_LOW.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select doc_id, unnest(list_distinct(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
  when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end)) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
near as (select x, y from pairs join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 75 * (p.n + q.n - c)),
links as (select x, y from near union select y, x from near),
reached as (select doc_id as x, doc_id as c from documents union select links.x, reached.c from links join reached on links.y = reached.x)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, r.c as component_id from documents d left join n on n.doc_id = d.doc_id join (select x, min(c) as c from reached group by x) r on r.x = d.doc_id
"""

EMBEDDINGS = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
fit as (select * from v where label is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from fit a join fit b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93),
reached as (select vec_id as x, vec_id as c from v union select links.x, reached.c from links join reached on links.y = reached.x),
many as (select x, count(*) as n from links group by x)
select v.vec_id, cast(coalesce(n, 0) as bigint) as n_links, r.c as component_id, v.vec_id = r.c as kept from v left join many on many.x = v.vec_id join (select x, min(c) as c from reached group by x) r on r.x = v.vec_id
"""


def url_sql(sites: list[tuple[str, str, str]], words: list[tuple[str, str]]) -> str:
    """Sites are (verdict, host, path), words (name, pattern of a host) that block what no site rule judges."""
    rules = ", ".join(f"('{v}', '{h}', '{p}', '{h}{p}')" for v, h, p in sites)
    patterns = ", ".join(f"('{n}', '(^|[^a-z0-9]){p}([^a-z0-9]|$)')" for n, p in words)
    return f"""
with rest as (select page_id, case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (select page_id, rest, regexp_extract(rest, '^[^/?#]*') as raw from rest),
u as (select page_id, {_LOW.format("raw")} as host, regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*') as path from h),
site(v, h, p, name) as (values {rules}), word(name, pattern) as (values {patterns}),
s as (select page_id, arg_max(name, length(name)) as rule, arg_max(v, length(name)) as v from u join site on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id),
w as (select page_id, max(name) as name from u join word on regexp_matches(host, pattern) group by page_id)
select u.page_id, host, path, s.rule, case when s.v is not null then s.v when w.name is not null then 'block' else 'allow' end as verdict, case when s.v is null then w.name end as pattern_rule
from u left join s on s.page_id = u.page_id left join w on w.page_id = u.page_id
"""


URLS = url_sql(
    [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")],
    [("cheap pills", "cheap[-_]pills"), ("free bets", "free[-_]bets"), ("casino", "casino"), ("adult", "adult"), ("porn", "porn"), ("xxx", "xxx"), ("viagra", "viagra"), ("ad trackers", "ads[-_]track")],
)

ORACLES = {"op1_ngram_jaccard_join": NGRAMS, "op4_embedding_dedup": EMBEDDINGS, "op5_line_dedup": line_dedup.ORACLE, "op9_url_filters": URLS}
