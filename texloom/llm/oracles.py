"""DuckDB SQL for the queries that SQL can express."""

from .licenses import oracle as _licenses
from .search import oracle as _search
from .veccodes import oracle as _vectors

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_line_dedup": """
with lines as (select doc_id, source, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> ''))) as line from documents where source is not null),
totals as (select source, count(*) as pages from documents group by source),
drops as (select source, list(line) as dropped from (select source, line, count(*) as n from lines group by source, line) c join totals t using (source) where n >= 3 and n > 0.1 * pages group by source),
kept as (select doc_id, d.source, text, string_split(text, chr(10)) as lines, dropped from documents d left join drops using (source))
select doc_id, source, case when dropped is null then text else array_to_string(list_filter(lines, lambda x: trim(x, ' ') = '' or not list_contains(dropped, x)), chr(10)) end as text,
 cast(coalesce(len(lines), 0) as bigint) as n_lines,
 cast(case when dropped is null or text is null then 0 else len(list_filter(lines, lambda x: trim(x, ' ') <> '' and list_contains(dropped, x))) end as bigint) as n_dropped
from kept""",
    "op3_decontamination": f"""
with doc_words as (select doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
item_words as (select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as w from benchmark where item_id is not null),
windows as (select distinct item, least(13, len(w)) as size, array_to_string(w[i + 1 : i + least(13, len(w))], ' ') as k from (select item, w, unnest(range(greatest(1, len(w) - 12))) as i from item_words where len(w) > 0)),
sizes as (select distinct size from windows),
starts as (select doc_id, w, size, unnest(range(len(w) - size + 1)) as i from doc_words, sizes where len(w) >= size),
found as (select doc_id, i, s.size, item from starts s join windows v on v.size = s.size and v.k = array_to_string(w[i + 1 : i + s.size], ' ')),
hits as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + size)) as p from found) group by doc_id),
items as (select doc_id, count(distinct item) as n, string_agg(distinct item, ',' order by item) as ids from found group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit, cast(coalesce(i.n, 0) as bigint) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
 coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) as contaminated
from doc_words d left join hits h using (doc_id) left join items i using (doc_id)""",
    "op4_warc": """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
f as (select hex, min(page_id) as first from p group by hex),
c as (select page_id, hex, html, first, list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substr(hex, 1 + 10 * (k // 8), 10) as bigint) >> (35 - 5 * (k % 8))) & 31 as integer), 1)) as letters from p join f using (hex))
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, array_to_string(letters, '') as payload_digest,
 case when page_id is null or page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from c""",
    "op6_chat_format": r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all select -7, 0, 'user', chr(92) || '### Assistant: </turn> ok' union all select -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'),
e as (select *, length(text) + length(text) - length(replace(text, chr(92), '')) + len(list_filter(range(1, length(text) + 1), lambda k: substr(text, k, 3) = '###')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
 + length(role) + length(role) - length(replace(replace(role, chr(92), ''), ':', '')) + len(list_filter(range(1, length(role) + 1), lambda k: substr(role, k, 3) = '###')) + (length(role) - length(replace(role, '</turn>', ''))) // 7
 + 14 as formatted from t)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
 sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
 sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
 sum(formatted)::bigint as formatted_chars
from e group by conv_id""",
    "op10_licenses": _licenses(),
    "op11_vector_codes": _vectors(),
    "op13_lexical_search": _search(),
}
