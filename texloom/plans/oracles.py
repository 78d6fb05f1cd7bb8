"""DuckDB SQL that gives the results of plans.queries from the driver's tables."""

from __future__ import annotations

import re

from .. import fixtures, schema
from ..functions import tex as T
from ..operators import colour, parse

_SAFE_DOCS = f"(select doc_id, source, regexp_replace(text, '{fixtures.SPECIAL}', '\\\\\\1', 'g') as text from documents) documents"
TEX, MORE, LOGS, BLOCKS = fixtures.TEX_DOCS, fixtures.MORE_DOCS, fixtures.LOGS, fixtures.blocks_sql("duckdb")
SAFE = TEX.replace("from documents", f"from {_SAFE_DOCS}")
PAPER_NAMES = ", ".join(f"'{x}'" for x in ("paper_original.tex", "paper_colored.tex", "paper_white.tex"))


def _re(pattern: str) -> str:
    """A pattern as a SQL string for RE2: no (?d), as its dot stops at newlines only."""
    return "'" + pattern.replace("(?d)", "").replace("'", "''") + "'"


def _str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(cte: str, values: str, name: str = "source_code") -> str:
    return f"with t as ({cte}), l as (select doc_id, {values} as l from t) select doc_id, cast(unnest(range(len(l))) as bigint) as idx, unnest(l) as {name} from l"


def _all(pattern: str, group: int = 0, of: str = "tex") -> str:
    return f"regexp_extract_all({of}, {_re(pattern)}, {group})"


#: Without line comments outside verbatim: RE2 has neither look-behind nor back-references, so escaped signs are hidden and each environment is a branch.
_KEPT = "|".join(rf"\\begin\{{{x}\}}[\s\S]*?\\end\{{{x}\}}" for x in (n.replace("*", "[*]") for n in schema.VERBATIM_ENVS)) + "|" + "|".join(rf"\\verb[*]?{c}[^\n]*?{c}" for c in ("[|]", "[+]", "!"))


def _uncommented(tex: str) -> str:
    return f"replace(regexp_replace(replace({tex}, '\\%', chr(1)), '({_KEPT})|%[^\\n]*', '\\1', 'g'), chr(1), '\\%')"


#: RE2 has no back-references: each spelling has its own branch.
_SPELLINGS = ["tabular*", "tabularx", "tabulary", "tabular", "tabu"]
_TABULAR = "(?s)" + "|".join(rf"\\begin\{{{x.replace('*', '[*]')}\}}.*?\\end\{{{x.replace('*', '[*]')}\}}" for x in _SPELLINGS)
_CODE = "(?s)" + "|".join(rf"\\begin\{{{x}[*]?\}}.*?\\end\{{{x}[*]?\}}" for x in ("verbatim", "lstlisting", "program")) + r"|\\lstinputlisting\[[^\]]*\]\{[^\}]*\}"
_FOOTNOTES = "list_concat(list_concat(" + ", ".join(_all(p) for p in list(T.FOOTNOTE.values())[:2]) + "), " + _all(T.FOOTNOTE["tablefootnote"]) + ")"
_GRAPHICS = "list_transform(range(1, len({p}) + 1), lambda k: concat(chr(92), 'includegraphics', case when coalesce({o}[k], '') <> '' then concat('[', {o}[k], ']') else '' end, '{{', {p}[k], '}}'))".format(o=_all(T.GRAPHICS, 1), p=_all(T.GRAPHICS, 2))
_TABULARS = f"list_filter({_all(_TABULAR)}, lambda x: not contains(x, chr(92) || 'includegraphics'))"


def _mentions(cte: str) -> str:
    parts = {"Caption": _all(T.CAPTION), "PaperTitle": _all(T.PAPER_TITLE), "Footnote": _FOOTNOTES, "Table": _TABULARS, "Algorithm": _all(T.ALGORITHM), "Code": _all(_CODE), "Figure": _GRAPHICS, "Abstract": f"case when len({_all(T.ABSTRACT)}) = 1 then {_all(T.ABSTRACT)} end"}
    return " union all ".join(f"select doc_id, '{c}' as category, cast(unnest(range(len(l))) as bigint) as idx, unnest(l) as source_code from (select doc_id, {v} as l from ({cte}) t_{c.lower()}) l_{c.lower()}" for c, v in parts.items())


def _colorize() -> str:
    c = "concat(category, '_color')"
    cut = "strpos(source_code, '{')"
    head, rest = f"substr(source_code, 1, {cut})", f"substr(source_code, {cut} + 1)"
    begin = r"length(regexp_extract(source_code, '^\\begin\{algorithm\*?\}'))"
    end = r"length(regexp_extract(source_code, '\\end\{algorithm\*?\}$'))"
    first = f"(strpos(substr(source_code, {begin} + 1), chr(92)) + {begin})"
    return f"""case when category in ('Table', 'Title', 'List', 'Code') then concat('{{', chr(92), 'color{{', {c}, '}}', source_code, '}}')
 when category in ('Text', 'Text-EQ') then concat('{{', chr(92), 'textcolor{{', {c}, '}}{{', source_code, '}}}}')
 when category in ('Caption', 'Footnote') then concat({head}, '{{', chr(92), 'color{{', {c}, '}}', {rest}, '}}')
 when category = 'Algorithm' then concat(substr(source_code, 1, {first} - 1), '{{', chr(92), 'color{{', {c}, '}}', substr(source_code, {first}, length(source_code) - {end} - {first} + 1), '}}', substr(source_code, length(source_code) - {end} + 1))
 when category = 'PaperTitle' then concat({head}, '{{', chr(92), 'textcolor{{', {c}, '}}{{', {rest}, '}}}}')
 when category = 'Abstract' then concat('{{', chr(92), 'begin{{abstract}}', chr(92), 'color{{', {c}, '}}', substr(source_code, 17), '}}') end"""


def _before(mark: str, new: str) -> str:
    return f"case when strpos(tex, {_str(mark)}) > 0 then concat(substr(tex, 1, strpos(tex, {_str(mark)}) - 1), {_str(new)}, substr(tex, strpos(tex, {_str(mark)}))) end"


_KIND = "case when category in ('Title', 'PaperTitle', 'Abstract') then 'title' when category = 'Footnote' then 'fn' else 'text' end"
def _orders(blocks: str) -> str:
    return f"""with b as ({blocks}), k as (select *, {_KIND} kind from b where category in ({', '.join(f"'{x}'" for x in schema.SORTABLE)})),
w as (select *, last_value(case when kind <> 'fn' then block_id end ignore nulls) over win as top_id, last_value(case when kind <> 'fn' then kind end ignore nulls) over win as top_kind, last_value(case when kind = 'title' then block_id end ignore nulls) over win as lt
 from k window win as (partition by doc_id order by ann_pos rows between unbounded preceding and 1 preceding)),
r as (select doc_id, block_id as from_id, top_id, lt, case when parent_block = top_id then 'identical' when kind = 'text' and top_kind = 'text' then 'adj' when kind = 'text' and top_kind = 'title' then 'sub' when kind = 'title' and lt is not null then 'peer' when kind = 'fn' and top_id is not null then 'explicit-cite' end as type from w)
select doc_id, type, from_id, case when type = 'peer' then lt else top_id end as to_id from r where type is not null"""


ORDERS = _orders(BLOCKS)
PAIRS = f"""with b as ({BLOCKS}) select a.doc_id, a.page_index, a.block_id as a_id, c.block_id as b_id, (least(a.x1, c.x1) - greatest(a.x0, c.x0)) * (least(a.y1, c.y1) - greatest(a.y0, c.y0)) as overlap
 from b a join b c on a.doc_id = c.doc_id and a.page_index = c.page_index and a.block_id < c.block_id and a.x0 <= c.x1 and c.x0 <= a.x1 and a.y0 <= c.y1 and c.y0 <= a.y1"""
CATEGORY_ID = "case category " + " ".join(f"when '{n}' then {i}" for i, n, _ in schema.CATEGORIES) + " end"


def _centres(pages: int, width: int) -> str:
    shift = f"case when page_index > 0 then {width} else 0 end"
    return f"""with o as ({ORDERS}), b as (select doc_id, block_id, (x0 + x1) / 2 + {shift} as x, (y0 + y1) / 2 as y from ({BLOCKS}) t where page_index < {pages})
select o.doc_id, type, from_id, to_id, f.x as from_x, f.y as from_y, t.x as to_x, t.y as to_y from o join b f on f.doc_id = o.doc_id and f.block_id = from_id join b t on t.doc_id = o.doc_id and t.block_id = to_id"""


def _spans(docs: str = MORE) -> str:
    parts = []
    for name in ("Table", "Figure", "Algorithm"):
        p = rf"(?s)\\begin\{{{name.lower()}\*?\}}.*?\\end\{{{name.lower()}\*?\}}"
        parts.append(f"""select doc_id, '{name}' as category, k as idx, list_sum(list_transform(range(1, k + 2), lambda j: length(gaps[j]))) + coalesce(list_sum(list_transform(range(1, k + 1), lambda j: length(spans[j]))), 0) as s, spans[k + 1] as span
 from (select *, unnest(range(len(spans))) as k from (select doc_id, {_all(p)} as spans, string_split_regex(tex, {_re(p)}) as gaps from ({docs}) t) u) v""")
    return f"select doc_id, category, cast(idx as bigint) as idx, cast(s as bigint) as span_start, cast(s + length(span) as bigint) as span_end, concat(category, ':', s::bigint) as float_key, array_to_string({_all(T.LABEL, 1, 'span')}, ',') as labels from ({' union all '.join(parts)}) p"


def _contained() -> str:
    return f"""with s as ({_spans()}), d as ({MORE}), m as (select m.*, strpos(tex, source_code) - 1 as a from ({_mentions(MORE)}) m join d using (doc_id) where category in ('Caption', 'Table')),
j as (select m.doc_id, m.category as m_category, m.idx, s.float_key, s.category, s.labels, row_number() over (partition by m.doc_id, m.category, m.idx order by case s.category when 'Table' then 1 when 'Figure' then 2 else 3 end desc, span_start desc) as r
 from m join s on s.doc_id = m.doc_id and a >= span_start and a + length(source_code) <= span_end where a >= 0)
select doc_id, m_category, idx, float_key, category, labels from j where r = 1"""


_TITLE = rf"(\\(?:sub)*section\*?{T.braces()}|\\chapter\*?{T.braces()})(?:\s*\\label\{{([^}}]*)\}})?"
_METRICS = f"""with l as ({LOGS}), p as (select doc_id, unnest(range(len(k))) as pos, unnest(k) as key, cast(unnest(v) as double) as value from (select doc_id, regexp_extract_all(log, '\\[layout: The (.*) is: ([-+]?\\d+\\.\\d+)pt\\]', 1) as k, regexp_extract_all(log, '\\[layout: The (.*) is: ([-+]?\\d+\\.\\d+)pt\\]', 2) as v from l) t),
x as (select doc_id, key, arg_max(value, pos) as value from p group by doc_id, key),
m as (select doc_id, {', '.join(f"max(case when key = '{k}' then value end) as {k}" for k in schema.LAYOUT_KEYS)} from x group by doc_id),
z as (select *, cast(round_even((textwidth + columnsep) / (columnwidth + columnsep), 0) as bigint) as num_columns, 72.27 + hoffset + oddsidemargin as margin_width, 72.27 + voffset - (topmargin - headheight) + headsep / 2 as margin_height from m)"""
_MANIFEST = "select cast(doc_id as varchar) as path, case when quality = 1 then 'success' else 'failed' end as status from labels"
_PROJECT = "select doc_id from documents"
_COLOURED_ORDER = r"\\(?:text)?color\{(" + "|".join(sorted((n for _, n, _ in schema.CATEGORIES), key=len, reverse=True)) + r")_color\}"


def _coloured() -> str:
    inner = T.braces()[2:-2]
    out = f"regexp_replace(tex, {_re(rf'(\\caption(?:\[[^\]]*\])?\{{)({inner})\}}')}, {_str(r'\1{\\color{Caption_color}\2}}')}, 'g')"
    for name in T.FOOTNOTE:
        out = f"regexp_replace({out}, {_re(rf'(\\{name}(?:\[[^\]]*\])?\{{)({inner})\}}')}, {_str(r'\1{\\color{Footnote_color}\2}}')}, 'g')"
    out = f"regexp_replace({out}, {_re(rf'(\\title\{{)({inner})\}}')}, {_str(r'\1{\\textcolor{PaperTitle_color}{\2}}}')}, 'g')"
    out = f"regexp_replace({out}, {_re(r'(?s)(\\begin\{abstract\})(.*?\\end\{abstract\})')}, {_str(r'{\1\\color{Abstract_color}\2}')}, 'g')"
    out = f"regexp_replace({out}, {_re(_TABULAR)}, {_str(r'{\\color{Table_color}\0}')}, 'g')"
    out = f"regexp_replace({out}, {_re(_CODE)}, {_str(r'{\\color{Code_color}\0}')}, 'g')"
    return f"regexp_replace({out}, {_re(r'(?s)(\\begin\{algorithm[*]?\}[^\\]*)(.*?)(\\end\{algorithm[*]?\})')}, {_str(r'\1{\\color{Algorithm_color}\2}\3')}, 'g')"


_MENTION_ORDER = f"""with c as (select doc_id, {_coloured()} as tex from ({MORE}) t), l as (select doc_id, tex, unnest(range(len(x))) as seq, unnest(x) as category from (select doc_id, tex, {_all(_COLOURED_ORDER, 1)} as x from c) u),
o as (select doc_id, tex, cast(seq as bigint) as seq, category, row_number() over (partition by doc_id, category order by seq) - 1 as idx from l)"""
_LINE = "length(substr(tex, 1, cast(position as integer))) - length(replace(substr(tex, 1, cast(position as integer)), chr(10), ''))"


def _edited() -> str:
    return rf"regexp_replace(regexp_replace(tex, {_re(T.FOOTNOTE['footnote'])}, '', 'g'), '(?s)\\begin\{{equation\}}.*?\\end\{{equation\}}', '[EQ]', 'g')"


_COCO_PAGES = f"select distinct doc_id, page_index from ({BLOCKS}) b"
_VALUES = ", ".join(f"({i}, '{n}', '{s}')" for i, n, s in schema.CATEGORIES)

# Blocks of documents by kind and number, as the queries make them, and their labels and references.
_TWO = f"select doc_id, tex from ({TEX}) a union all select doc_id + 1000000000, tex from ({MORE}) b"
_BLOCK_LISTS = {
    "PaperTitle": _all(T.PAPER_TITLE), "Title": _all(r"\\(?:sub)*section\*?\{[^{}]*\}"), "Equation": _all(r"(?s)\\begin\{equation\}.*?\\end\{equation\}"), "Text": "string_split(tex, chr(10) || chr(10))",
    "Footnote": _FOOTNOTES, "Caption": _all(T.CAPTION), "Table": _TABULARS, "Algorithm": _all(T.ALGORITHM),
}
_DOCUMENT_BLOCKS = " union all ".join(
    f"select doc_id, cast({k + 1} * 100000 + unnest(range(len(l))) as bigint) as block_id, cast({k + 1} * 100000 + unnest(range(len(l))) as bigint) as ann_pos, '{c}' as category, null::bigint as parent_block, unnest(l) as source_code from (select doc_id, {v} as l from two) l_{c.lower()}"
    for k, (c, v) in enumerate(_BLOCK_LISTS.items()))
_ANNOTATED_ORDERS = f"""with two as ({_TWO}), blocks as ({_DOCUMENT_BLOCKS}),
heads as (select doc_id, unnest(range(len(a))) as idx, unnest(a) as title, unnest(b) as nxt from (select doc_id, {_all(_TITLE, 1)} as a, {_all(_TITLE, 2)} as b from two) u),
hl as (select doc_id, idx, title, unnest(list_append({_all(T.LABEL, 1, 'title')}, coalesce(nxt, ''))) as label from heads),
hf as (select doc_id, title, label from (select *, min(idx) over (partition by doc_id, title) as f from hl where label <> '') x where idx = f),
sp as ({_spans('select * from two')}),
m as (select b.*, strpos(tex, source_code) - 1 as a from blocks b join two using (doc_id) where category in ('Caption', 'Table', 'Algorithm') and source_code <> ''),
held as (select m.doc_id, m.category as m_category, m.block_id, sp.* exclude (doc_id) from m join sp on sp.doc_id = m.doc_id and a >= span_start and a + length(source_code) <= span_end where a >= 0),
cap as (select doc_id, block_id, arg_max(float_key, (case category when 'Table' then 1 when 'Figure' then 2 else 3 end)::bigint * 1000000000 + span_start) as label from held where m_category = 'Caption' group by doc_id, block_id),
labelled as (select b.doc_id, b.block_id, label from blocks b join hf on hf.doc_id = b.doc_id and hf.title = b.source_code where category = 'Title'
 union all select doc_id, block_id, unnest({_all(T.LABEL, 1, 'source_code')}) from blocks where category = 'Equation'
 union all select doc_id, block_id, unnest(list_append(list_filter(string_split(labels, ','), lambda x: x <> ''), float_key)) from held where category = m_category),
owners as (select doc_id, label, max(block_id) as to_id from labelled group by doc_id, label),
cited as (select doc_id, block_id, 'explicit-cite' as type, unnest(list_filter({_all(T.REFERENCE, 1, 'source_code')}, lambda x: x <> '')) as label from blocks where category in ('Text', 'Text-EQ', 'Table', 'Algorithm') union all select doc_id, block_id, 'implicit-cite', label from cap)
select doc_id, type, from_id, to_id from ({_orders('select * from blocks')}) o union all select c.doc_id, c.type, c.block_id, o.to_id from cited c join owners o on o.doc_id = c.doc_id and o.label = c.label"""

_REGIONS = fixtures.regions_sql("duckdb")


def _mention_blocks(column: str, where: str) -> str:
    """Boxes of regions by page and column; those that overlap in sequence are one. With two columns at most a page's second box meets the first one's own."""
    w = "window w as (partition by doc_id, category, idx order by page_index, col)"
    meets = "lag(page_index) over w = page_index and least(x1, lag(x1) over w) > greatest(x0, lag(x0) over w) and least(y1, lag(y1) over w) > greatest(y0, lag(y0) over w)"
    return f"""select doc_id, idx as seq, fragment, case when fragment > 0 then fragment - 1 end as parent_fragment, category, min(page_index) as page_index, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from (
 select *, cast(sum(fresh) over (partition by doc_id, category, idx order by page_index, col) - 1 as bigint) as fragment from (
 select *, case when {meets} then 0 else 1 end as fresh from (
 select doc_id, category, idx, page_index, {column} as col, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from ({_REGIONS}) r where {where} group by all) e {w}) f) g group by doc_id, category, idx, fragment"""


_ONE_COLUMN = ", ".join(f"'{x}'" for x in schema.ONE_COLUMN)
_LAYOUT = f"""with pages as (select distinct doc_id, page_index from ({_REGIONS}) r), b as ({BLOCKS}),
f as (select 1 as kind, null::bigint as seq, null::bigint as fragment, null::bigint as parent_fragment, b.doc_id, 'Figure' as category, b.page_index, x0 * 2 as x0, (792 - y1) * 2 as y0, x1 * 2 as x1, (792 - y0) * 2 as y1, null as source_code from b join pages p on p.doc_id = b.doc_id and p.page_index = b.page_index where category in ('Figure', 'Table')),
m as (select 0 as kind, q.*, b.source_code from ({_mention_blocks('0', 'true')}) q join b on b.doc_id = q.doc_id and b.ann_pos = q.seq and b.category = q.category),
a as (select kind, seq, fragment, parent_fragment, doc_id, category, page_index, x0, y0, x1, y1, source_code from m union all select * from f),
n as (select *, row_number() over (partition by doc_id order by kind, seq nulls first, fragment nulls first, page_index, y0, x0, y1, x1) - 1 as block_id from a)
select doc_id, block_id, category, page_index, x0, y0, x1, y1, case when parent_fragment is not null then block_id - 1 end as parent_block, source_code from n"""
_PLACES = "list_transform(range(1, len(m) + 1), lambda k: list_sum(list_transform(range(1, k + 1), lambda j: length(g[j]))) + coalesce(list_sum(list_transform(range(1, k), lambda j: length(m[j]))), 0))"

#: Tokens without look-ahead: a run of text is taken whole, and the white space that it begins with is counted apart.
_DELIM = "|".join(re.escape(x) for x in parse.DELIMITERS)
_TOKEN = r"\\[^A-Za-z\[\]()\x00\x7f]|%[^\n]*|\$\$|\$|\\[(\[)\]]|[\x00\x7f]+|\\(?:" + "|".join(parse.SIZES) + rf")(?:{_DELIM})|\\[A-Za-z]+\*?|\\|[{{}}\[\]]|[^\\{{}}$\[\]%\x00\x7f]+"
_CATEGORY = "case t " + " ".join(f"when '{m}' then '{n}'" for m, n in [("$$", "DisplayMath"), ("$", "Math"), ("{", "GroupBegin"), ("}", "GroupEnd"), ("[", "BracketBegin"), ("]", "BracketEnd"), (r"\(", "MathBegin"), (r"\[", "MathBegin"), (r"\)", "MathEnd"), (r"\]", "MathEnd"), ("\\", "Escape")]) + rf" else case when t[1] = '%' then 'Comment' when regexp_matches(t, '^[\x00\x7f]') then 'Ignored' when regexp_full_match(t, '\\(?:{'|'.join(parse.SIZES)})(?:{_DELIM})') then 'Punctuation' when regexp_matches(t, '^\\[A-Za-z]') then 'Command' when t[1] = '\' then 'Escaped' else 'Text' end end"
_TOKENS = rf"""with d as ({SAFE}), l as (select doc_id, regexp_extract_all(tex, {_re(_TOKEN)}) as l from d), r as (select doc_id, unnest(l) as t, unnest(list_append(l[2:], null)) as nx from l),
c as (select t, nx, {_CATEGORY} as category, regexp_extract(t, '^[ \t\n]*') as w from r),
s as (select *, length(w) - length(replace(w, chr(10), '')) as lines, w = t and (nx is null or not regexp_matches(nx, '^[\x00\x7f]')) as whole from c where category = 'Text'),
p as (select case when whole then greatest(1, lines) else greatest(0, lines - 1) end as n, case when whole then length(t) when lines > 1 then length(w) - strpos(reverse(w), chr(10)) else 0 end as chars, whole, length(t) as size from s),
a as (select category, 1 as n, length(t) as chars from c where category <> 'Text' union all select 'Spacer', n, chars from p where n > 0 union all select 'Text', 1, size - chars from p where not whole)
select category, cast(sum(n) as bigint) as n, cast(sum(chars) as bigint) as chars from a group by category"""

_FAILURES = f"select doc_id, case doc_id % 5 when 0 then concat('Caption at ', length(tex), ': not closed') when 1 then concat('Footnote at ', length(tex), ': not closed') else 'Abstract: several' end as error from ({MORE}) t where doc_id % 5 < 3"

_FILES = fixtures.PROJECT_FILES
#: kind, pattern, extensions by rank
_NAMED = [("include", r"\\(?:input|include)\{([^}]*)\}", ["", ".tex"]), ("graphics", r"\\includegraphics(?:\[[^\]]*\])?\{([^}]*)\}", ["", ".pdf", ".png", ".jpg", ".jpeg", ".eps", ".ps"]), ("bibliography", r"\\bibliography\{([^}]*)\}", ["", ".bib"])]
_EDGES = f"""files as materialized ({_FILES}),
names as (""" + " union all ".join(f"select doc_id, path, '{kind}' as kind, {extensions} as extensions, unnest(list_distinct(flatten(list_transform(regexp_extract_all(tex, '{pattern}', 1), lambda x: string_split(x, ','))))) as name from files" for kind, pattern, extensions in _NAMED) + """),
tried as (select doc_id, path, kind, name, unnest(extensions) as e, unnest(range(len(extensions))) as rank from names),
edges as materialized (select distinct t.doc_id, t.path, kind, f.path as target from tried t join files f on f.doc_id = t.doc_id and f.path = regexp_replace(name, '^[.]/', '') || e qualify row_number() over (partition by t.doc_id, t.path, kind, name order by rank) = 1)"""

ORACLES: dict[str, str] = {
    "q01_env_labels": _listed(TEX, _all(T.LABEL, 1), "label"),
    "q02_env_refs": _listed(TEX, f"list_filter({_all(T.REFERENCE, 1)}, lambda x: x <> '')", "label"),
    "q03_cross_ref_edges": f"""with t as ({TEX}), p as (select doc_id, unnest(range(len(l))) as pos, unnest(l) as s from (select doc_id, string_split(tex, chr(10) || chr(10)) as l from t) u),
b as (select doc_id, doc_id * 1000 + pos as block_id, pos, case when contains(s, chr(92) || 'caption') then 'implicit-cite' else 'explicit-cite' end as type, s from p),
o as (select doc_id, label, arg_max(block_id, pos) as to_id from (select doc_id, block_id, pos, unnest({_all(T.LABEL, 1, 's')}) as label from b) x group by doc_id, label),
r as (select doc_id, type, block_id as from_id, unnest({_all(T.REFERENCE, 1, 's')}) as label from b)
select r.doc_id, type, from_id, to_id from r join o on o.doc_id = r.doc_id and o.label = r.label where r.label <> ''""",
    "q04_reading_order": ORDERS,
    "q05_order_type_counts": f"select type, count(*) as n_relations, count(distinct doc_id) as n_docs from ({ORDERS}) o group by type",
    "q06_page_quality": f"""with b as ({BLOCKS}), g as (select doc_id, page_index, count(*) as n, sum(abs((x1 - x0) * (y1 - y0))) as area from b group by doc_id, page_index),
o as (select doc_id, page_index, sum(overlap) as overlap from ({PAIRS}) p group by doc_id, page_index),
r as (select doc_id, page_index, cast(sum(n) as bigint) as num_blocks, sum(area) as area, sum(coalesce(overlap, 0)) as overlap from g left join o using (doc_id, page_index) group by rollup(doc_id, page_index))
select doc_id, coalesce(cast(page_index as varchar), 'total') as page, num_blocks, area, overlap, case when area = 0 then 0.0 else overlap / area end as ratio from r where doc_id is not null""",
    "q07_category_quality": f"""with b as ({BLOCKS}), g as (select doc_id, category, count(*) filter (where parent_block is null) as g from b where category <> 'Figure' group by doc_id, category),
m as (select doc_id, category, count(*) as m from b where parent_block is null and ann_pos % 7 <> 3 or category = 'List' group by doc_id, category),
r as (select doc_id, category, cast(sum(coalesce(g, 0)) as bigint) as geometry_count, cast(sum(coalesce(m, 0)) as bigint) as reading_count from g full join m using (doc_id, category) group by rollup(doc_id, category))
select doc_id, coalesce(category, 'Total') as category, geometry_count, reading_count, case when reading_count = 0 then 0.0 else 1 - cast(geometry_count as double) / reading_count end as missing_rate from r where doc_id is not null""",
    "q07_report_header": f"select doc_id, max(page_index) + 1 as num_pages from ({BLOCKS}) b group by doc_id",
    "q08_page_overlap": f"select doc_id, page_index, sum(overlap) as overlap, count(*) as n_pairs from ({PAIRS}) p group by doc_id, page_index",
    "q08_overlap_pairs": PAIRS,
    "q09_coco_annotations": f"select doc_id, page_index as image_id, row_number() over (partition by doc_id, page_index order by ann_pos, block_id) - 1 as id, cast({CATEGORY_ID} as bigint) as category_id, x0 as x, y0 as y, x1 - x0 as width, y1 - y0 as height, (x1 - x0) * (y1 - y0) as area, cast(0 as bigint) as iscrowd from ({BLOCKS}) b",
    "q10_coco_images": f"select doc_id, page_index as id, cast(612 as bigint) as width, cast(792 as bigint) as height, concat('page_', lpad(cast(page_index as varchar), 4, '0'), '.jpg') as file_name from ({_COCO_PAGES}) p",
    "q10_coco_categories": f"select cast(id as bigint) as id, name, supercategory from (values {_VALUES}) v(id, name, supercategory) where name in (select category from ({BLOCKS}) b)",
    "q40_categories": f"select cast(id as bigint) as id, name, supercategory, coalesce(n, 0) as n_blocks from (values {_VALUES}) v(id, name, supercategory) left join (select category as name, count(*) as n from ({BLOCKS}) b group by category) c using (name)",
    "q11_reading_annotation": f"select doc_id, block_id, [x0, y0, x1, y1] as bbox, category, page_index, source_code from ({BLOCKS}) b",
    "q12_relation_centres_single": _centres(1, 0),
    "q12_relation_centres_two_page": _centres(2, 612),
    "q13_captions": _listed(TEX, _all(T.CAPTION)),
    "q13_footnotes": _listed(TEX, _FOOTNOTES),
    "q13_titles": _listed(TEX, _all(T.PAPER_TITLE)),
    "q14_abstract": f"with l as (select doc_id, {_all(T.ABSTRACT)} as l from ({TEX}) t) select doc_id, case when len(l) = 1 then l[1] end as source_code, case when len(l) = 1 then 'ok' else 'multiple' end as status from l where len(l) > 0",
    "q15_tabular": _listed(f"select * from ({MORE}) a union all select * from ({TEX}) b", _TABULARS),
    "q15_algorithm": _listed(MORE, _all(T.ALGORITHM)),
    "q15_code": _listed(MORE, _all(_CODE)),
    "q16_graphics": _listed(MORE, _GRAPHICS),
    "q17_text_paragraphs": rf"""with t as (select doc_id, concat(text, chr(10), chr(10), chr(10), text, ' a $x$ \(y\) ', chr(10), chr(10), ' ', chr(10), chr(10), 'end') as tex from documents),
l as (select doc_id, list_filter(string_split(replace(tex, chr(10) || chr(10), chr(1) || chr(10) || chr(10) || chr(1)), chr(1)), lambda x: x <> '') as l from t),
p as (select doc_id, cast(unnest(range(len(l))) as bigint) as idx, unnest(l) as source_code from l)
select doc_id, idx, case when len(list_filter(regexp_extract_all(source_code, '(\\\(.*?\\\))|(\$.*?\$)|(\\begin\{{math\}}.*?\\end\{{math\}})', 1), lambda x: not contains(coalesce(x, ''), chr(92) || '$'))) > 0 then 'Text-EQ' else 'Text' end as category, source_code from p where regexp_matches(source_code, '[^\s\x0b]')""",
    "q18_colorize_mentions": f"select doc_id, category, idx, {_colorize()} as coloured from ({_mentions(MORE)} union all {_mentions(TEX)}) m",
    "q19_strip_comments": rf"select doc_id, regexp_replace(tex, '(?s)\\begin\{{comment\}}(.*?)\\end\{{comment\}}', '', 'g') as tex from ({TEX}) t",
    "q19_blank_lines": rf"select doc_id, regexp_replace(regexp_replace(tex, '\n\s*\n', chr(10) || chr(10), 'g'), '\A\s*\n', '') as tex from ({MORE}) t",
    "q19_contents_lists": rf"select doc_id, regexp_replace(tex, '\\({'|'.join(schema.TABLES_OF_CONTENTS)})', '', 'g') as tex from ({MORE}) t",
    "q19_plain_graphics": rf"select doc_id, regexp_replace(tex, '\\(?:psfig|epsfig)\{{(.*?)\}}', '\\includegraphics{{\1}}', 'g') as tex, regexp_extract(tex, '(?s)\\graphicspath\{{\{{(.+?)\}}', 1) as graphics_path from ({MORE}) t",
    "q19_strip_line_comments": f"select doc_id, {_uncommented('tex')} as tex from ({MORE}) t",
    "q20_color_definitions": f"select doc_id, {_before(chr(92) + 'begin{document}', colour.definitions())} as tex from ({MORE}) t",
    "q20_layout_messages": f"select doc_id, {_before(chr(92) + 'end{document}', colour.layout_messages())} as tex from ({MORE}) t",
    "q20_own_colours": rf"""select doc_id, regexp_replace(case when regexp_matches(string_split(tex, '\begin{{document}}')[1], '\\usepackage(?:\[.*?\])?\{{hyperref\}}') then {_before(chr(92) + 'begin{document}', chr(92) + 'hypersetup{colorlinks=false}' + chr(10))} else tex end, '\\lstset\{{.*?\}}', '', 'g') as tex from ({MORE}) t""",
    "q20_white": f"select doc_id, {_before(chr(92) + 'begin{document}', colour.definitions('255, 255, 255'))} as tex from ({MORE}) t",
    "q21_main_content": rf"select doc_id, substr(tex, a + 16, b - a - 16) as content, cast(a + 15 as bigint) as start_pos, cast(b - 1 as bigint) as end_pos from (select doc_id, tex, strpos(tex, '\begin{{document}}') as a, strpos(tex, '\end{{document}}') as b from ({TEX}) t) u",
    "q22_replace_nth": "select doc_id, case when n < 1 or len(p) <= n then text else concat(array_to_string(p[1:n], 'the'), 'THE', array_to_string(p[n + 1:], 'the')) end as text from (select doc_id, text, doc_id % 5 as n, string_split(text, 'the') as p from documents) t",
    "q22_mention_order": f"{_MENTION_ORDER} select doc_id, seq, category, idx from o",
    "q22_variants": f"""{_MENTION_ORDER}, x as (select *, string_split(tex, concat('color{{', category, '_color}}')) as p from o)
select doc_id, seq, concat('paper_block__', lpad(cast(seq as varchar), 5, '0'), '_', category, '_', lpad(cast(idx as varchar), 5, '0')) as name, md5(concat(list_reduce(p[1:idx + 1], lambda a, b: concat(a, 'color{{', category, '_color}}', b)), 'color{{black}}', list_reduce(p[idx + 2:], lambda a, b: concat(a, 'color{{', category, '_color}}', b)))) as tex_md5 from x""",
    "q23_float_spans": _spans(),
    "q23_mentions_in_floats": _contained(),
    "q23_caption_relations": f"with c as ({_contained()}) select a.doc_id, a.float_key, a.idx as caption_idx, b.m_category as body_category, b.idx as body_idx from c a join c b on a.doc_id = b.doc_id and a.float_key = b.float_key where a.m_category = 'Caption' and b.m_category = 'Table'",
    "q24_title_labels": f"""with t as (select * from ({MORE}) a union all select * from ({TEX}) b), l as (select doc_id, unnest(range(len(a))) as idx, unnest(a) as title, unnest(b) as nxt from (select doc_id, {_all(_TITLE, 1)} as a, {_all(_TITLE, 2)} as b from t) u),
x as (select doc_id, idx, title, unnest(list_append({_all(T.LABEL, 1, 'title')}, coalesce(nxt, ''))) as label from l) select doc_id, cast(idx as bigint) as idx, title, label from x where label <> ''""",
    "q26_enclosing_boxes": f"select doc_id, page_index, category, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from ({BLOCKS}) b group by all",
    "q27_layout_metrics": f"{_METRICS} select doc_id, columnwidth, textwidth, num_columns, round(margin_width, 6) as margin_width, round(margin_height, 6) as margin_height from z",
    "q27_separations": f"""{_METRICS}, p as (select distinct doc_id, page_index from ({BLOCKS}) b),
s as (select doc_id, page_index, list_concat(list_concat([0.0::double], list_transform(range(1, greatest(num_columns, 1)), lambda k: (margin_width - 0.5 * columnsep + k * (columnwidth + columnsep)) * (72.0 / 72.27) * 2)), [1224.0::double]) as l from p join z using (doc_id))
select doc_id, page_index, 2.0::double as px2img, cast(unnest(range(len(l))) as bigint) as k, round(unnest(l), 6) as x from s""".replace(", p as (select distinct", ", pg as (select distinct").replace("from p join z", "from pg join z"),
    "q27_columns": f"select block_id, cast(case when category in ({', '.join(repr(x) for x in schema.ONE_COLUMN)}) then 0 when x0 >= 100 then 1 else 0 end as bigint) as col from ({BLOCKS}) b",
    "q28_pdf_to_image": f"select doc_id, page_index, block_id, x0 * s as x0, y0 * s as y0, x1 * s as x1, y1 * s as y1 from (select *, cast(page_index % 3 + 1 as double) as s from ({BLOCKS}) b) t",
    "q28_figure_boxes": f"select doc_id, page_index, 'Figure' as category, x0, 792 - y1 as y0, x1, 792 - y0 as y1 from ({BLOCKS}) b where category = 'Table'",
    "q28_source_lines": f"select doc_id, doc_id % 12 + 1 as line_no, string_split(tex, chr(10))[doc_id % 12 + 1] as source_code from ({TEX}) t",
    "q28_page_pairs": f"""with p as ({_COCO_PAGES}), a as (select * from p where (doc_id + page_index) % 5 <> 1), b as (select * from p where (doc_id + page_index) % 7 <> 1 or (doc_id + page_index) % 5 = 1)
select doc_id, page_index, a.doc_id is null or b.doc_id is null as missing from a full join b using (doc_id, page_index)""",
    "q28_numbered_blocks": f"select doc_id, page_index, ann_pos, category, row_number() over (partition by doc_id order by page_index, ann_pos) - 1 as block_id from ({BLOCKS}) b",
    "q29_manifest_success": f"select path from ({_MANIFEST}) m where status = 'success'",
    "q29_skip_processed": f"select cast(doc_id as varchar) as path, source from documents where cast(doc_id as varchar) not in (select path from ({_MANIFEST}) m where status = 'success')",
    "q30_metadata_upsert": "select cast(doc_id as varchar) as paper_id, case when doc_id % 3 <> 0 then 'known' else source end as source, n_chars from documents",
    "q31_main_documents": f"""with f as (select doc_id, tex, concat('/data/cs/p', doc_id, case when doc_id % 5 = 0 then '/sub' else '' end, '/', case doc_id % 6 when 0 then 'paper_original.tex' when 1 then 'paper_block__00001_Text.tex' when 2 then 'notes.txt' else 'main.tex' end) as path from ({TEX}) t where doc_id % 7 <> 0)
select path, 'cs' as discipline, concat('p', doc_id) as paper_id, cast(length(tex) as bigint) as n_chars from f where path like '%.tex' and path not like '%paper_block_%' and string_split(path, '/')[-1] not in ({PAPER_NAMES}) and len(string_split(path, '/')) = 5""",
    "q32_include_edges": f"select doc_id, path, cast(seq as bigint) as seq, target from ({_PROJECT}) d, (values ('main.tex', 0, 'a.tex'), ('main.tex', 1, 'missing.tex'), ('main.tex', 2, 'sub/b.tex'), ('a.tex', 0, 'sub/b.tex')) v(path, seq, target)",
    "q32_include_resolution": "select doc_id, 'main.tex' as path, concat('start A[B', doc_id, '] mid ', chr(92), 'include{missing} B', doc_id, ' end', doc_id) as tex from documents",
    "q32_include_chain": "select doc_id, 'f0.tex' as path, concat(array_to_string(list_transform(range(11), lambda k: k || '<'), ''), 'end ', chr(92), 'input{f0} ', chr(92), 'input{f11}', repeat('>' || doc_id, 11)) as tex from documents",
    "q33_dependency_intersection": "select doc_id, 'main.tex' as path from documents union all select doc_id, concat('f', doc_id % 4, '.png') as path from documents where doc_id % 4 = doc_id % 3",
    "q33_missing_files": "select doc_id, concat('f', doc_id % 4) as path from documents where doc_id % 4 <> doc_id % 3",
    "q34_char_pos_to_line": f"select doc_id, cast(position as bigint) as position, cast({_LINE} as bigint) as line, cast(length(string_split(substr(tex, 1, cast(position as integer)), chr(10))[-1]) as bigint) as column from (select *, doc_id * 37 % 200 as position from ({TEX}) t) u",
    "q35_tree_count": rf"""with t as ({SAFE}), c as (select doc_id, unnest(['label', 'section', 'item', 'equation', 'caption']) as name, unnest([len(regexp_extract_all(tex, '\\label\{{')), len(regexp_extract_all(tex, '\\section\{{')), len(regexp_extract_all(tex, '\\item ')), len(regexp_extract_all(tex, '\\begin\{{equation\}}')), len(regexp_extract_all(tex, '\\caption'))]) as n from t) select doc_id, name, n from c where n > 0""",
    "q35_tree_find_first_label": rf"select doc_id, regexp_extract(tex, '\\label\{{.*?\}}') as source from ({SAFE}) t",
    "q35_tree_children": f"select doc_id, cast(2 as bigint) as n_items from ({SAFE}) t",
    "q35_tree_descendants": "select doc_id, cast((doc_id % 5 <> 0)::int + (doc_id % 2 = 0)::int as bigint) as n_labels from documents where doc_id % 5 <> 0 or doc_id % 2 = 0",
    "q35_tree_search": f"with t as ({SAFE}), m as (select doc_id, unnest(regexp_extract_all(tex, 'cost|hidden')) as body from t) select doc_id, body, count(*) as n from m group by doc_id, body",
    "q35_tree_positions": rf"select doc_id, cast(length(substr(tex, 1, p)) - length(replace(substr(tex, 1, p), chr(10), '')) as bigint) as line, cast(0 as bigint) as column from (select doc_id, tex, strpos(tex, '\section') - 1 as p from ({SAFE}) t) u",
    "q35_tree_arguments": "select doc_id, concat('bracket:s|group:C {n {m}} ', source) as args from documents where doc_id % 2 = 0",
    "q35_tree_edit": f"select doc_id, {_edited()} as tex from ({SAFE}) t",
    "q36_tokens_round_trip": TEX,
    "q37_segments_round_trip": SAFE,
    "q38_connected_boxes": "select doc_id, cast(0 as bigint) as page_index, k as box, 3 + doc_id % 7 as x0, 5 + 12 * k as y0, 20 + k as x1, 12 + 12 * k as y1 from (select doc_id, unnest(range(doc_id % 4)) as k from documents) t",
    "q39_id_normalise": "select concat('2301.', lpad(cast(doc_id as varchar), 5, '0')) as paper_id, concat('http://papers.example/abs/2301.', lpad(cast(doc_id as varchar), 5, '0'), case when doc_id % 2 = 0 then concat('v', doc_id % 9 + 1) else '' end) as entry_id from documents",
    "q39_paper_records": """select concat('http://papers.example/abs/2301.', lpad(cast(doc_id as varchar), 5, '0'), 'v10') as entry_id, '2023-01-10' as updated, '2023-01-01' as published, concat(source, ' 10') as title, null::varchar as doi, concat(source, ',', lang) as authors, md5(text) as summary,
 null::varchar as journal_ref, lang as primary_category, lang as categories, concat('http://papers.example/pdf/', doc_id) as links, concat('http://papers.example/pdf/', doc_id) as pdf_url, concat('2301.', lpad(cast(doc_id as varchar), 5, '0')) as paper_id,
 case when doc_id % 3 = 0 then concat('/data/cs/', doc_id) end as paper_path, 'low' as quality from documents""",
    "q39_first_distinct": "select distinct source as id from documents order by id limit 7",
    "q41_segment_mentions": rf"""with t as ({SAFE}) select doc_id, 'Title' as category, cast(0 as bigint) as idx, regexp_extract(tex, '\\section\{{.*?\}}') as source_code from t
union all select doc_id, 'List', 0, regexp_extract(tex, '(?s)\\begin\{{itemize\}}.*?\\end\{{itemize\}}') from t
union all select doc_id, 'Equation', 0, regexp_extract(tex, '\\begin\{{equation\}}.*?\\end\{{equation\}}') from t where doc_id % 5 <> 0""",
    "q42_clean_documents": rf"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_uncommented('tex')}, '\\({'|'.join(schema.TABLES_OF_CONTENTS)})', '', 'g'), '\\(?:psfig|epsfig)\{{(.*?)\}}', '\\includegraphics{{\1}}', 'g'), '\n\s*\n', chr(10) || chr(10), 'g'), '\A\s*\n', '') as tex from ({MORE}) t""",
    "q42_clean_project": "select doc_id, 'main.tex' as path, concat('start A[B', doc_id, '] mid ', chr(92), 'include{missing} B', doc_id, ' end', doc_id) as content from documents union all select doc_id, 'sub/b.tex', concat('B', doc_id) from documents",
    "q43_overlay": f"select doc_id, concat('page_', lpad(cast(page_index as varchar), 4, '0'), '.jpg') as file_name, ann_pos as z, x0, y0, x1, y1, category as label, {schema.BOX_COLOURS}[{CATEGORY_ID} + 1] as colour from ({BLOCKS}) b",
    "q44_argument_lists": "select doc_id, case when doc_id % 2 = 0 then '{a}{n}[o]{b}' else '{a}{b}{z}' end as args, case when doc_id % 2 = 0 then '{n}[o]{b}{a}' else '{b}{z}{a}' end as rotated, doc_id % 2 = 0 as has_option from documents",
    "q42_annotated_orders": _ANNOTATED_ORDERS,
    "q45_mention_blocks": _mention_blocks(f"case when category in ({_ONE_COLUMN}) then 0 when x0 >= 150 then 1 else 0 end", "idx % 11 <> 4"),
    "q45_layout_annotation": _LAYOUT,
    "q46_layout_round_trip": BLOCKS,
    "q46_reading_of_relations": f"""select doc_id, case when doc_id % 5 < 2 then -1 else n end as n_blocks, case doc_id % 5 when 0 then 'no annotations' when 1 then 'no document' end as error from (select doc_id, count(*) as n from ({BLOCKS}) b group by doc_id) t where doc_id % 7 <> 0""",
    "q47_quality_reports": f"""{_METRICS}, bl as ({BLOCKS}), q as (select doc_id, max(page_index) + 1 as num_pages, count(distinct case when category <> 'Figure' then category end) + 1 as n_categories, count(distinct page_index) as n_pages, count(*) as num_blocks, sum(abs((x1 - x0) * (y1 - y0))) as area from bl group by doc_id)
select q.doc_id, num_pages, num_columns, n_categories, n_pages, num_blocks, area from q join z using (doc_id)""",
    "q49_deep_groups": "select doc_id, cast(k as bigint) as idx, case when k = 0 then concat(chr(92), 'caption[s]{', source, repeat('{x', cast(doc_id % 30 + 1 as integer)), repeat('}', cast(doc_id % 30 + 2 as integer))) else chr(92) || 'caption{plain}' end as source_code from documents, (values (0), (1)) t(k)",
    "q49_coloured_deep_groups": "select doc_id, concat(chr(92), 'title{{', chr(92), 'textcolor{PaperTitle_color}{', repeat('{x', cast(doc_id % 30 + 1 as integer)), source, repeat('}', cast(doc_id % 30 + 1 as integer)), '}}} b ', chr(92), 'caption{{', chr(92), 'color{Caption_color}plain}}', chr(92), 'footnote{{', chr(92), 'color{Footnote_color}}}') as tex from documents",
    "q44_argument_slices": "select doc_id, case when doc_id % 2 = 0 then '[o]{b}' else '{b}[o]' end as middle, case when doc_id % 2 = 0 then '{b}{c}' else '[o]{a}' end as last, '' as none, '[k]{v}' as parsed from documents",
    "q35_tree_search_places": f"with t as (select doc_id, regexp_extract_all(tex, 'cost|hidden') as m, string_split_regex(tex, 'cost|hidden') as g from ({SAFE}) t), p as (select doc_id, unnest(m) as body, unnest({_PLACES}) as position from t) select doc_id, body as there, body, cast(position as bigint) as position from p",
    "q35_tree_strings": rf"select doc_id, regexp_extract(tex, '\\label\{{(.*?)\}}', 1) as string, regexp_replace(tex, '\\label\{{.*?\}}', concat('\\label{{new:', doc_id, '}}')) as tex from ({SAFE}) t",
    "q35_tree_insertions": rf"select doc_id, regexp_replace(replace(replace(tex, '\footnote{{', '<f>\footnote{{'), '\end{{itemize}}', '<end>\end{{itemize}}'), '(?s)(\\begin\{{equation\}}.*?\\end\{{equation\}})', '\1\1', 'g') as tex from ({SAFE}) t",
    "q19_resolved_graphics": f"select doc_id, replace(replace(tex, concat('{{h', doc_id % 4, '}}'), concat('{{h', doc_id % 4, '.png}}')), concat('{{h', doc_id % 5, '.pdf}}'), concat('{{h', doc_id % 5, '.png}}')) as tex from ({MORE}) t",
    "q50_dependency_edges": f"with {_EDGES} select * from edges",
    "q50_dependencies": f"with recursive {_EDGES}, reach(doc_id, path) as (select doc_id, path from files where path = 'f0.tex' union select e.doc_id, e.target from reach r join edges e on e.doc_id = r.doc_id and e.path = r.path) select * from reach",
    "q36_tokens_by_category": _TOKENS,
    "q51_native_tokens": _TOKENS,
    "q51_token_places": rf"""with d as ({MORE}), m as (select doc_id, string_split_regex(tex, '\\[A-Za-z]+[*]?|\\[^A-Za-z]|%[^\n]*') as gaps, regexp_extract_all(tex, '\\[A-Za-z]+[*]?|\\[^A-Za-z]|%[^\n]*') as hits from d),
u as (select doc_id, gaps, hits, unnest(range(len(hits))) as k from m), p as (select doc_id, hits[k + 1] as t, list_sum(list_transform(gaps[1 : k + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : k], lambda x: length(x))), 0) as pos from u)
select doc_id, cast(pos as integer) as char_pos, t as there, t as text from p where regexp_matches(t, '^\\[A-Za-z]')""",
    "q51_environments": rf"""with d as ({SAFE}), n as (select doc_id, tex, unnest(['document', 'abstract', 'equation', 'table', 'tabular', 'figure', 'comment', 'itemize', 'verbatim']) as name from d)
select doc_id, name, cast(strpos(tex, concat('\begin{{', name, '}}')) - 1 as integer) as char_pos, cast(strpos(tex, concat('\end{{', name, '}}')) + length(name) + 5 as integer) as char_end, case when name = 'document' then 1 when name = 'tabular' then 3 else 2 end as level, cast(null as varchar) as error from n where strpos(tex, concat('\begin{{', name, '}}')) > 0""",
    "q51_brackets": rf"""with d as ({SAFE}), m as (select doc_id, string_split_regex(tex, '\\[\s\S]|\{{[^{{}}\\]*\}}|%[^\n]*') as gaps, regexp_extract_all(tex, '\\[\s\S]|\{{[^{{}}\\]*\}}|%[^\n]*') as hits from d),
u as (select doc_id, gaps, hits, unnest(range(len(hits))) as k from m), p as (select doc_id, hits[k + 1] as t, list_sum(list_transform(gaps[1 : k + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : k], lambda x: length(x))), 0) as pos from u)
select doc_id, cast(pos as integer) as char_pos, substr(t, 2, length(t) - 2) as inside from p where t[1] = '{{'""",
    "q52_dictionary_mentions": rf"""with t as (select doc_id, lower(n_name) as nation, r_name as region, n_nationkey as k, text from (select doc_id, regexp_replace(text, '{fixtures.SPECIAL}', '\\\1', 'g') as text from documents) d join nation on n_nationkey = doc_id % 25 join region on n_regionkey = r_regionkey),
f as (select r_name as france, n_nationkey % 3 = 0 as early from nation join region on n_regionkey = r_regionkey where n_name = 'FRANCE'),
m as (select doc_id, 0 as place, nation as name, case when k % 3 = 0 then 'FIRST' else region end as category, concat('\begin{{', nation, '}}', text, '\begin{{algeria}}in\end{{algeria}}\end{{', nation, '}}') as source_code from t
union all select doc_id, 1, 'france', case when early then 'FIRST' else france end, '\begin{{france}}b\end{{france}}' from t, f where doc_id % 2 = 0
union all select doc_id, 2, nation, case when k % 3 = 0 then 'FIRST' else region end, concat('\begin{{', nation, '}}c\end{{', nation, '}}') from t)
select doc_id, category, row_number() over (partition by doc_id, category order by place) - 1 as idx, name, source_code from m""",
    "q53_failures": _FAILURES,
    "q53_statuses": f"select doc_id, case when error is null then 'success' else 'failed' end as status, error from ({MORE}) t left join ({_FAILURES}) f using (doc_id)",
    "q54_nested_edits": rf"""with s as ({SAFE}), m as (select doc_id, regexp_replace(tex, '(\\begin\{{equation\}})\\label\{{eq:[0-9]\}}', '\1') as tex from s),
e as (select doc_id, replace(tex, '\end{{document}}', concat(case when doc_id % 5 <> 0 then concat('\label{{eq:', doc_id % 5, '}}') else '' end, '\end{{document}}')) as tex from m),
i as (select doc_id, replace(tex, concat('\item a', chr(10), '\item b', chr(10)), concat('\item a', chr(10), '\item a', chr(10), '\item b', chr(10), '\item b', chr(10))) as tex from e),
t as (select doc_id, regexp_replace(replace(tex, '\end{{table}}', '<t>\end{{table}}'), '(?s)\\begin\{{tabular\}}.*?\\end\{{tabular\}}', '[T]') as tex from i)
select doc_id, regexp_replace(tex, '(?s)\\begin\{{abstract\}}.*?\\end\{{abstract\}}', '') as tex from t""",
    "q54_edited_numbers": """with r as (select doc_id, unnest([{'name': 'document', 'depth': 0, 'n': 1}, {'name': 'itemize', 'depth': 1, 'n': 1}, {'name': 'item', 'depth': 2, 'n': 2}, {'name': 'label', 'depth': 1, 'n': 1}, {'name': 'equation', 'depth': 1, 'n': cast(doc_id % 5 <> 0 as int)},
 {'name': 'table', 'depth': 1, 'n': cast(doc_id % 2 = 0 as int)}, {'name': 'tabular', 'depth': 2, 'n': cast(doc_id % 2 = 0 as int)}, {'name': 'caption', 'depth': 2, 'n': cast(doc_id % 2 = 0 as int)}, {'name': 'label', 'depth': 2, 'n': cast(doc_id % 5 <> 0 as int) + cast(doc_id % 2 = 0 as int)}]) as x from documents)
select doc_id, x['name'] as name, cast(x['depth'] as bigint) as depth, cast(x['n'] as bigint) as n from r where x['n'] > 0""",
    "q55_placed_mentions": f"""with t as (select doc_id, concat(tex, tex) as tex, length(tex) as size from ({MORE}) d), m as (""" + " union all ".join(
        f"select doc_id, tex, size, '{c}' as category, unnest(range(len(l))) as idx, unnest(l) as s from (select doc_id, tex, size, {v} as l from t) x_{c.lower()}" for c, v in {"Caption": _all(T.CAPTION), "Table": _TABULARS, "Algorithm": _all(T.ALGORITHM)}.items()) + """),
k as (select *, row_number() over (partition by doc_id, category, s order by idx) as n from m)
select doc_id, category, idx, case when n = 1 then strpos(tex, s) - 1 else size + strpos(substr(tex, size + 1), s) - 1 end as m_start, substr(s, 1, 20) as begins from k""",
    "q56_static_clean_project": rf"""with recursive {_EDGES}, reach(doc_id, path) as (select doc_id, path from files where path = 'f199.tex' union select e.doc_id, e.target from reach r join edges e on e.doc_id = r.doc_id and e.path = r.path),
c as (select doc_id, path, case when path like '%.tex' then regexp_replace(regexp_replace(tex, '\n\s*\n', chr(10) || chr(10), 'g'), '^\s*\n', '') else tex end as content from files join (select distinct * from reach) r using (doc_id, path) where path <> 'f199.tex')
select doc_id, path, md5(content) as content_md5, length(content) as n_chars from c""",
    "q57_page_files": """select concat('/out/', doc_id, '/thread-0001-page-', lpad(cast(doc_id % 40 + 1 as varchar), 2, '0'), '.jpg') as path, cast(doc_id % 40 as integer) as page_index, cast(null as integer) as seq, cast(null as varchar) as category, cast(null as integer) as idx from documents
union all select concat('/out/', doc_id, '/paper_block_', lpad(cast(doc_id % 7 as varchar), 5, '0'), '_', c, '_', lpad(cast(doc_id % 3 as varchar), 5, '0')), null, cast(doc_id % 7 as integer), c, cast(doc_id % 3 as integer) from (select doc_id, case when doc_id % 2 = 0 then 'Text-EQ' else 'Table' end as c from documents) d""",
    "q57_paths": r"""with p as (select doc_id, source, concat(source, '/p', doc_id, '/fig.v1', case when doc_id % 2 = 0 then '.tex' else '' end) as below from documents where source is not null)
select doc_id, concat('\data\', below) as path, below, concat(source, '/p', doc_id, case when doc_id % 2 = 0 then '/fig.v1.png' else '/fig.png' end) as png, concat('{', doc_id, '}') as inner, string_split(source, '/')[-1] as discipline from p""",
    "q57_batches": "select count(distinct doc_id) as n_ids, true as fits from documents",
    "q57_styled": rf"""with a as (select doc_id, {_before(chr(92) + 'begin{document}', colour.definitions())} as tex from ({MORE}) t), b as (select doc_id, {_before(chr(92) + 'end{document}', colour.layout_messages())} as tex from a)
select doc_id, regexp_replace(case when regexp_matches(string_split(tex, '\begin{{document}}')[1], '\\usepackage(?:\[.*?\])?\{{hyperref\}}') then {_before(chr(92) + 'begin{document}', chr(92) + 'hypersetup{colorlinks=false}' + chr(10))} else tex end, '\\lstset\{{.*?\}}', '', 'g') as tex from b""",
    "q57_mention_lists": f"select doc_id, category, count(*) as n, md5(string_agg(source_code, '|' order by idx)) as texts_md5 from ({_mentions(TEX)}) m group by doc_id, category",
    "q11_layout_info": f"""with b as ({BLOCKS}), p as (select doc_id, cast(page_index as varchar) as page, to_json(list({{'block_id': block_id, 'category': category, 'page_index': page_index, 'parent_block': coalesce(parent_block, -1), 'source_code': source_code, 'bbox': [x0, y0, x1, y1]}} order by ann_pos)) as j from b group by doc_id, page_index)
select doc_id, concat('{{', string_agg(concat('"', page, '":', j), ',' order by page), '}}') as layout from p group by doc_id""",
    "q11_order_annotation": f"select doc_id, cast(to_json(list({{'type': type, 'from': from_id, 'to': to_id}} order by from_id, type, to_id)) as varchar) as orders from ({ORDERS}) o group by doc_id",
    "q10_coco_documents": f"""with b as ({BLOCKS}), a as (select *, row_number() over (partition by doc_id, page_index order by ann_pos, block_id) - 1 as id, {CATEGORY_ID} as cat from b),
n as (select doc_id, to_json(list({{'id': id, 'image_id': page_index, 'category_id': cast(cat as bigint), 'bbox': [x0, y0, x1 - x0, y1 - y0], 'area': (x1 - x0) * (y1 - y0), 'iscrowd': 0, 'segmentation': cast([] as double[])}} order by page_index, id)) as anns from a group by doc_id),
i as (select doc_id, to_json(list({{'id': page_index, 'width': 612, 'height': 792, 'file_name': concat('page_', lpad(cast(page_index as varchar), 4, '0'), '.jpg')}} order by page_index)) as images from (select distinct doc_id, page_index from b) p group by doc_id)
select doc_id, concat('{{"images":', images, ',"annotations":', anns, ',"categories":', (select to_json(list({{'id': id, 'name': name, 'supercategory': supercategory}} order by id)) from (values {_VALUES}) v(id, name, supercategory)), '}}') as coco from i join n using (doc_id)""",
}
