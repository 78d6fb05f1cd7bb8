"""LaTeX text transforms as Column expressions: Catalyst sees all of them.

Patterns are Java's: `.` stops at a newline only under (?d), braces are escaped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ..schema import FOOTNOTES, REFERENCES, TABLES_OF_CONTENTS, TABULARS, VERBATIM_ENVS

#: Nesting of braces that patterns follow; deeper ones are found brace by brace.
DEPTH = 6


def braces(depth: int = DEPTH) -> str:
    """Pattern of a balanced brace group; it does not honour escapes."""
    inner = r"[^{}]"
    for _ in range(depth):
        inner = rf"(?:[^{{}}]|\{{{inner}*\}})"
    return rf"\{{{inner}*\}}"


# What counts as a mention, as patterns.
LABEL = r"(?d)\\label\{(.*?)\}"
REFERENCE = rf"(?d)\\(?:{'|'.join(REFERENCES)})\{{(.*?)\}}"
GRAPHICS = r"(?d)\\includegraphics(?:\[(.*?)\])?\{(.*?)\}"
CAPTION_HEAD = r"\\caption(?:\[[^\]]*\])?"
TITLE_HEAD = r"\\title"
FOOTNOTE_HEADS = {name: rf"\\{name}(?:\[[^\]]*\])?" for name in FOOTNOTES}
ABSTRACT = r"(?s)\\begin\{abstract\}.*?\\end\{abstract\}"
TABULAR = rf"(?s)\\begin\{{({'|'.join(x.replace('*', '[*]') for x in sorted(TABULARS, key=len, reverse=True))})\}}.*?\\end\{{\1\}}"
ALGORITHM = r"(?s)\\begin\{algorithm[*]?\}(.*?)\\end\{algorithm[*]?\}"
CODE = r"(?s)\\begin\{(verbatim|lstlisting|program)[*]?\}(.*?)\\end\{\1[*]?\}|\\lstinputlisting\[[^\]]*\]\{[^\}]*\}"
MATH = r"(?d)(\\\(.*?\\\))|(\$.*?\$)|(\\begin\{math\}.*?\\end\{math\})"

CAPTION, PAPER_TITLE = CAPTION_HEAD + braces(), TITLE_HEAD + braces()
FOOTNOTE = {name: head + braces() for name, head in FOOTNOTE_HEADS.items()}
_VERBATIM = "|".join(x.replace("*", "[*]") for x in sorted(VERBATIM_ENVS, key=len, reverse=True))


def every(tex: Column | str, pattern: str, group: int = 0) -> Column:
    """All matches in order."""
    return F.regexp_extract_all(tex, F.lit(pattern), F.lit(group))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is one variable: named many times, it is neither copied nor computed again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cut(tex: Column, head: str) -> Column:
    """tex as an array whose elements add up to it: heads with their opening brace, single braces, and what lies between."""
    return F.regexp_extract_all(tex, F.lit(rf"{head}\{{|[{{}}]|[^{{}}\\]+|\\"), F.lit(0))


def _walked(pieces: Column, head: str) -> Column:
    """found: the first and last piece of each group that a head opens, none within another; open: the first pieces of those that never close.

    One fold over the pieces, which remembers the heads that are open and the depth that each lies at.
    """
    places = "array<struct<first:int,depth:int>>"
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("depth"), F.array().cast(places).alias("open"), F.array().cast("array<struct<first:int,last:int>>").alias("found"))

    def step(a: Column, x: Column) -> Column:
        plain = ~F.endswith(x, F.lit("{")) & (x != "}")
        here = F.struct((a["k"] + 1).alias("k"), a["depth"].alias("depth"), a["open"].alias("open"), a["found"].alias("found"))
        opened = F.struct((a["k"] + 1).alias("k"), (a["depth"] + 1).alias("depth"), F.when(x != "{", F.array_append(a["open"], F.struct(a["k"].alias("first"), a["depth"].alias("depth")))).otherwise(a["open"]).alias("open"), a["found"].alias("found"))
        return F.when(plain, here).when(x == "}", _let(F.try_element_at(a["open"], F.lit(-1)), lambda top: closed(a, top))).otherwise(opened)

    def closed(a: Column, top: Column) -> Column:
        depth = F.greatest(a["depth"] - 1, F.lit(0))
        ends = top.isNotNull() & (top["depth"] == depth) & (a["depth"] > 0)
        found = F.array_append(F.filter(a["found"], lambda f: f["first"] < top["first"]), F.struct(top["first"].alias("first"), a["k"].alias("last")))
        rest = F.slice(a["open"], F.lit(1), F.greatest(F.size(a["open"]) - 1, F.lit(0)))
        return F.struct((a["k"] + 1).alias("k"), depth.alias("depth"), F.when(ends, rest).otherwise(a["open"]).alias("open"), F.when(ends, found).otherwise(a["found"]).alias("found"))

    return F.aggregate(pieces, start, step, lambda a: F.struct(a["found"].alias("found"), F.transform(a["open"], lambda o: o["first"]).alias("open")))


def _piece(pieces: Column, first: Column, last: Column) -> Column:
    return F.array_join(F.slice(pieces, first + 1, F.greatest(last - first + 1, F.lit(0))), "")


def _simple(text: Column, head: str, matches: Column) -> Column:
    """Whether matches, those of the pattern with braces of DEPTH, are all groups that head opens: then none is deeper, holds another or stays open."""
    return F.size(matches) == F.regexp_count(text, F.lit(rf"{head}\{{"))


def _headless(text: Column, head: str) -> Column:
    """Whether head opens no group at all: most texts lack most heads, and are then searched once."""
    return ~F.rlike(text, F.lit(rf"{head}\{{"))


def groups(tex: Column | str, head: str) -> Column:
    """Every head with the brace group that follows, in order, whatever its depth; none within another. Those that never close are none."""
    text = F.col(tex) if isinstance(tex, str) else tex

    def deep(t: Column) -> Column:
        return _let(_cut(t, head), lambda p: F.transform(_walked(p, head)["found"], lambda s: _piece(p, s["first"], s["last"])))

    some = lambda t: _let(every(t, head + braces()), lambda m: F.when(_simple(t, head, m), m).otherwise(deep(t)))
    return _let(text, lambda t: F.when(_headless(t, head), F.array().cast("array<string>")).otherwise(some(t)))


def gapped(tex: Column | str, pattern: str) -> Column:
    """All matches in order, each with the length of what lies between it and the one before: array<struct<gap, text>>."""
    both = F.arrays_zip(F.transform(F.split(tex, pattern, -1), F.length).alias("gap"), every(tex, pattern).alias("text"))
    return F.filter(both, lambda x: x["text"].isNotNull())


def gapped_groups(tex: Column | str, head: str) -> Column:
    """groups(), each with the length of what lies between it and the one before: array<struct<gap, text>>."""
    text = F.col(tex) if isinstance(tex, str) else tex

    def places(p: Column, found: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(found, i - 1)["last"]).otherwise(-1)
        return F.transform(found, lambda s, i: F.struct(F.length(_piece(p, before(i) + 1, s["first"] - 1)).alias("gap"), _piece(p, s["first"], s["last"]).alias("text")))

    def deep(t: Column) -> Column:
        return _let(_cut(t, head), lambda p: _let(_walked(p, head)["found"], lambda found: places(p, found)))

    return _let(text, lambda t: F.when(_simple(t, head, every(t, head + braces())), gapped(t, head + braces())).otherwise(deep(t)))


def unclosed(tex: Column | str, head: str) -> Column:
    """Offsets (from 0) of the heads whose group never closes."""
    text = F.col(tex) if isinstance(tex, str) else tex

    def deep(t: Column) -> Column:
        return _let(_cut(t, head), lambda p: F.transform(_walked(p, head)["open"], lambda k: F.length(_piece(p, F.lit(0), k - 1))))

    return _let(text, lambda t: F.when(_simple(t, head, every(t, head + braces())), F.array().cast("array<int>")).otherwise(deep(t)))


def with_groups(tex: Column, head: str, before: str, after: str) -> Column:
    """tex with `before` behind each opening brace that head opens, and `after` before the closing one."""
    inner = braces()[2:-2]

    def plain(text: Column) -> Column:
        return F.regexp_replace(text, rf"({head}\{{)({inner})\}}", rf"$1{before}$2{after}}}".replace("\\", "\\\\"))

    def deep(pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def step(a: Column, s: Column) -> Column:
            opening = F.get(pieces, s["first"])
            new = F.array(_piece(pieces, a["at"], s["first"] - 1), opening, F.lit(before), _piece(pieces, s["first"] + 1, s["last"] - 1), F.lit(after + "}"))
            return F.struct((s["last"] + 1).alias("at"), F.concat(a["out"], new).alias("out"))

        return F.aggregate(_walked(pieces, head)["found"], start, step, lambda a: F.concat(F.array_join(a["out"], ""), _piece(pieces, a["at"], F.size(pieces))))

    return _let(tex, lambda t: F.when(_headless(t, head), t).when(_simple(t, head, every(t, head + braces())), plain(t)).otherwise(_let(_cut(t, head), deep)))


def _gone(tex, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(tex, pattern, by)


def without_comment_envs(tex) -> Column:
    return _gone(tex, r"(?s)\\begin\{comment\}(.*?)\\end\{comment\}")


def without_line_comments(tex) -> Column:
    r"""Drops % to the end of the line unless a backslash escapes it; verbatim environments and \verb stay."""
    verbatim = rf"\\begin\{{({_VERBATIM})\}}.*?\\end\{{\2\}}|\\verb[*]?([^\sa-zA-Z*])[^\n]*?\3"
    return _gone(tex, rf"(?s)({verbatim})|(?<!\\)((?:\\\\)*)%[^\n]*", "$1$4")


def without_spare_blank_lines(tex) -> Column:
    return _gone(_gone(tex, r"\n\s*\n", "\n\n"), r"\A\s*\n")


def without_contents_lists(tex) -> Column:
    return _gone(tex, rf"\\({'|'.join(TABLES_OF_CONTENTS)})")


def with_plain_graphics(tex) -> Column:
    r"""\psfig and \epsfig become \includegraphics."""
    return _gone(tex, r"(?d)\\(?:psfig|epsfig)\{(.*?)\}", r"\\includegraphics{$1}")


def graphics_path(tex) -> Column:
    return F.regexp_extract(tex, r"(?s)\\graphicspath\{\{(.+?)\}", 1)


def main_content(tex) -> tuple[Column, Column, Column]:
    r"""(text between the first \begin{document} and \end{document}, its start, its end), offsets from 0; null where either is missing."""
    start = F.locate(r"\begin{document}", tex)
    stop = F.locate(r"\end{document}", tex)
    first, last = start - 1 + F.lit(len(r"\begin{document}")), stop - 1
    fine = (start > 0) & (stop > 0)
    text = F.col(tex) if isinstance(tex, str) else tex
    return F.when(fine, F.substring(text, first + 1, F.greatest(last - first, F.lit(0)))), F.when(fine, first.cast("long")), F.when(fine, last.cast("long"))


def spliced(text: Column, start: Column, stop: Column, new: Column) -> Column:
    """text with new in place of what lies from start to stop (offsets from 0)."""
    return F.concat(F.substring(text, F.lit(1), start.cast("int")), new, F.substring(text, stop.cast("int") + 1, F.length(text)))


def replace_nth(text: Column, old: str, new, n) -> Column:
    """The n-th occurrence (from 1) of old by new; unchanged where there are fewer."""
    parts = F.split(text, rf"\Q{old}\E", -1)
    n = n if isinstance(n, Column) else F.lit(n)
    new = new if isinstance(new, Column) else F.lit(new)
    joined = F.concat(F.array_join(F.slice(parts, F.lit(1), F.greatest(n, F.lit(1))), old), new, F.array_join(F.slice(parts, F.greatest(n, F.lit(1)) + 1, F.size(parts)), old))
    return F.when((n < 1) | (F.size(parts) <= n), text).otherwise(joined)


def paragraphs(text: Column) -> Column:
    r"""Splits on \n\n and keeps the separators; empty pieces go."""
    return F.filter(F.flatten(F.transform(F.split(text, "\n\n", -1), lambda x, i: F.when(i > 0, F.array(F.lit("\n\n"), x)).otherwise(F.array(x)))), lambda x: x != "")


def is_text_eq(text: Column) -> Column:
    r"""Whether text has inline math other than \(..\) around an escaped dollar."""
    return F.exists(every(text, MATH, 1), lambda x: ~F.contains(x, F.lit(r"\$")))


def without_outer_braces(text: Column) -> Column:
    return _gone(text, r"(?d)\A\{(.*)\}\z", "$1")


def line_and_column(tex: Column, position: Column) -> tuple[Column, Column]:
    """(line, column), both from 0, of a character offset from 0."""
    before = F.substring(tex, F.lit(1), position)
    line = F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit("")))
    return line.cast("long"), F.length(F.substring_index(before, "\n", -1)).cast("long")


def relative_path(path: Column, base: Column) -> Column:
    """path below base, with forward slashes."""
    unix, root = F.replace(path, F.lit("\\"), F.lit("/")), F.concat(F.regexp_replace(F.replace(base, F.lit("\\"), F.lit("/")), "/+$", ""), F.lit("/"))
    return F.when(F.startswith(unix, root), F.substring(unix, F.length(root) + 1, F.length(unix))).otherwise(unix)


def with_extension(path: Column, extension: str) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(extension))


def normalised_id(entry_id: Column) -> Column:
    """The last part of an entry URL without its version."""
    return F.regexp_extract(entry_id, r"([^/]+?)(v\d+)?$", 1)


def group_kind(text: Column) -> Column:
    """'bracket' or 'group' for a string in brackets or braces, else null."""
    inside = F.length(text) > 1
    return F.when(inside & F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]")), "bracket").when(inside & F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}")), "group")


def group_of(text: Column, strict: bool = False) -> Column:
    """struct<kind, text> of a string in brackets or braces; null for anything else, or a failed query if strict."""
    kind = group_kind(text)
    made = F.when(kind.isNotNull(), F.struct(kind.alias("kind"), F.substring(text, F.lit(2), F.length(text) - 2).alias("text")))
    return made if not strict else F.when(kind.isNull(), F.raise_error(F.concat(F.lit("no group: "), F.substring(text, 1, 40)))).otherwise(made)
