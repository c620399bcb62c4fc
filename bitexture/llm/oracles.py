"""DuckDB statements for the queries of this folder that SQL can express."""

from __future__ import annotations

from bitexture.llm.line_dedup import MIN_WORDS

WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op10_line_dedup"] = rf"""
with split as (
    select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as no
    from documents
),
lines as (
    select *, len(regexp_extract_all(line, '{WORD}')) as words from split
),
worded as (
    select doc_id, line, no, words, row_number() over d - 1 as at, sum(words) over d as upto
    from lines where words > 0 window d as (partition by doc_id order by no)
),
forwards as (
    select a.doc_id, a.at as first, min(b.at) as last
    from worded a join worded b on a.doc_id = b.doc_id and b.at >= a.at and b.upto - a.upto + a.words >= {MIN_WORDS}
    group by 1, 2
),
backwards as (
    select b.doc_id, max(a.at) as first, b.at as last
    from worded a join worded b on a.doc_id = b.doc_id and b.at >= a.at and b.upto - a.upto + a.words >= {MIN_WORDS}
    group by 1, 3
),
runs as (
    select r.doc_id, r.first, r.last, string_agg(w.line, chr(10) order by w.at) as content
    from (select * from forwards union select * from backwards) r
    join worded w on w.doc_id = r.doc_id and w.at between r.first and r.last
    group by 1, 2, 3
),
placed as (
    select *, row_number() over (partition by content order by doc_id, first) as copy from runs
),
gone as (
    select distinct w.doc_id, w.no
    from placed p join worded w on w.doc_id = p.doc_id and w.at between p.first and p.last
    where p.copy > 1
),
kept as (
    select l.doc_id, string_agg(l.line, chr(10) order by l.no) filter (where g.no is null) as text,
           count(g.no) as n_removed_lines
    from lines l left join gone g on g.doc_id = l.doc_id and g.no = l.no
    group by 1
)
select doc_id, n_removed_lines, coalesce(text, '') as text from kept
"""

ORACLES["op2_topk_products"] = """
with vectors as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as vector
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2])) as bigint) as score
    from vectors q join vectors c on c.vec_id <> q.vec_id and len(c.vector) = len(q.vector)
    where q.vec_id % 20 = 0
),
ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

ORACLES["op12_phrase_dedup"] = rf"""
with worded as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents
),
windows as (
    select doc_id, pos, sha256(array_to_string(words[pos : pos + 12], ' ')) as content
    from (select doc_id, words, unnest(generate_series(1, len(words) - 12)) as pos from worded where len(words) >= 13)
),
owners as (
    select content, min(doc_id) as owner from windows group by 1 having min(doc_id) < max(doc_id)
),
gone as (
    select w.doc_id, list(distinct p.pos) as places
    from windows w join owners o on o.content = w.content and o.owner < w.doc_id,
         lateral (select unnest(generate_series(w.pos, w.pos + 12)) as pos) p
    group by 1
)
select w.doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(places), 0) as bigint) as n_removed,
       sha256(case when places is null then array_to_string(words, ' ') else coalesce(array_to_string(
           list_transform(list_filter(list_zip(words, generate_series(1, len(words))), lambda p: not list_contains(places, p[2])), lambda p: p[1]), ' '), '') end)
       as kept_sha256
from worded w left join gone g on g.doc_id = w.doc_id
"""


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
