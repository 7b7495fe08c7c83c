"""DuckDB SQL for the numbered queries that SQL can express, written from the contracts alone."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

NEAR_DUPLICATES = f"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_SPACED}) as w from documents
),
sets as (
    select doc_id, case
        when len(w) < 2 then w
        else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
    from words
),
elements as (select doc_id, len(s) as n, unnest(s) as x from sets),
shared as (
    select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as common
    from elements a join elements b on a.x = b.x and a.doc_id < b.doc_id
    where 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.doc_id, b.doc_id
),
links as (select a, b from shared where 100 * common >= 80 * (n + m - common)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
    select doc_id, doc_id from sets
    union
    select r.doc_id, e.b from reach r join edges e on r.other = e.a
),
least_of as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, len(s.s)::bigint as n_shingles, l.component_id, s.doc_id = l.component_id as kept
from sets s join least_of l on s.doc_id = l.doc_id
"""

CONTAMINATION = f"""
with doc_words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_LETTERS}) as w from documents
),
item_words as (
    select item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_LETTERS}) as w from benchmark
),
windows as (
    select distinct item_id, least(10, len(w)) as size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as run
    from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from item_words where len(w) > 0)
),
sizes as (select distinct size from windows),
places as (
    select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as run
    from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from doc_words, sizes where len(w) >= size)
),
found as (select p.doc_id, p.i, p.size, w.item_id from places p join windows w on p.run = w.run and p.size = w.size),
hit as (
    select doc_id, count(distinct k) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as k from found) group by doc_id
),
items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, item_id::varchar as item from found) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(i.n_items, 0)::bigint as n_items,
    sha256(coalesce(i.listed, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hit h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""

#: Forty hexadecimal digits to base 32: five of them are twenty bits, or four letters.
_BASE32 = (
    "array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), "
    "lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    "1 + ((('0x' || substr(digest, 1 + 5 * g, 5))::int // (32 ** (3 - k))::int) % 32)::int, 1)), '')), '')"
)

ARCHIVES = f"""
with bodies as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(encode(coalesce(html, ''))) as digest from pages
),
latest as (select *, max(page_id) over (partition by digest) as last_id from bodies)
select page_id, payload_bytes::bigint as payload_bytes, {_BASE32} as payload_digest,
    case when page_id = last_id then 'response' else 'revisit' end as record_type,
    case when page_id = last_id then null else last_id end as refers_to
from latest
"""


def _removed(unit: str, width: int) -> str:
    """Common part of the two passage queries: runs of covered units of texts (doc_id, body, n), half open, from 1."""
    return f"""
windows as (select doc_id, i, md5({unit}) as run from (select doc_id, body, unnest(range(1, n - {width} + 2)) as i from texts where n >= {width})),
firsts as (select run, min(doc_id) as first_id from windows group by run having min(doc_id) < max(doc_id)),
covered as (select distinct w.doc_id, w.i from windows w join firsts f on w.run = f.run where w.doc_id > f.first_id),
marked as (select doc_id, i, coalesce(i > lag(i) over (partition by doc_id order by i) + {width}, true)::int as fresh from covered),
numbered as (select doc_id, i, sum(fresh) over (partition by doc_id order by i) as k from marked),
runs as (select doc_id, k, min(i) as lo, max(i) + {width} as hi from numbered group by doc_id, k),
pieces as (
    select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 1) as since,
        lead(lo) over (partition by doc_id order by lo) is null as last
    from runs
),
kept as (
    select doc_id, since as lo, lo as hi from pieces
    union all
    select p.doc_id, p.hi, t.n + 1 from pieces p join texts t on p.doc_id = t.doc_id where p.last
),
removed as (select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans from runs group by doc_id)"""


SUBSTRINGS = f"""
with texts as (
    select doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) as body,
        len(regexp_extract_all(coalesce(text, ''), {_SPACED})) as n
    from documents
),
{_removed("array_to_string(body[i:i + 49], ' ')", 50)},
rest as (
    select k.doc_id, string_agg(array_to_string(t.body[k.lo:k.hi - 1], ' '), ' ' order by k.lo) as left_over
    from kept k join texts t on k.doc_id = t.doc_id where k.hi > k.lo group by k.doc_id
)
select t.doc_id, t.n::bigint as n_words, coalesce(r.n_removed, 0)::bigint as n_removed,
    sha256(case when r.doc_id is null then array_to_string(t.body, ' ') else coalesce(x.left_over, '') end) as kept_sha256
from texts t left join removed r on t.doc_id = r.doc_id left join rest x on t.doc_id = x.doc_id
"""

BYTES = f"""
with texts as (
    select doc_id, encode(coalesce(text, '')) as body, octet_length(encode(coalesce(text, ''))) as n from documents
),
{_removed("body[i:i + 49]", 50)},
rest as (
    select k.doc_id, string_agg(hex(t.body[k.lo:k.hi - 1]), '' order by k.lo) as left_over
    from kept k join texts t on k.doc_id = t.doc_id where k.hi > k.lo group by k.doc_id
)
select t.doc_id, t.n::bigint as n_bytes, coalesce(r.n_removed, 0)::bigint as n_removed, coalesce(r.n_spans, 0)::bigint as n_spans,
    sha256(case when r.doc_id is null then t.body else unhex(coalesce(x.left_over, '')) end) as kept_sha256
from texts t left join removed r on t.doc_id = r.doc_id left join rest x on t.doc_id = x.doc_id
"""

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": NEAR_DUPLICATES,
    "op2_decontamination": CONTAMINATION,
    "op6_warc": ARCHIVES,
    "op8_substring_dedup": SUBSTRINGS,
    "op10_suffix_array_dedup": BYTES,
}
