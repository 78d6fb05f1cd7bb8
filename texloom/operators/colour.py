"""Colouring: wrapping mentions in colour commands, preambles, and one variant per mention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tex as T
from ..schema import CATEGORIES, LAYOUT_KEYS
from .parse import parse_segments
from .segments import categorised

#: What log lines of layout lengths begin with.
LOG_TAG = "layout"


def colorize(text: Column, category: Column) -> Column:
    """text wrapped in its category's colour; null for categories that have no wrapper (Figure, Others, Reference)."""
    colour = F.concat(category, F.lit("_color"))
    cut = F.locate("{", text)
    head, rest = F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text))
    begin = F.length(F.regexp_extract(text, r"\A\\begin\{algorithm\*?\}", 0))
    first = F.locate("\\", F.substring(text, begin + 1, F.length(text))) + begin
    end = F.length(text) - F.length(F.regexp_extract(text, r"\\end\{algorithm\*?\}\z", 0))
    algorithm = F.concat(F.substring(text, F.lit(1), first - 1), F.lit(r"{\color{"), colour, F.lit("}"), F.substring(text, first, end - first + 1), F.lit("}"), F.substring(text, end + 1, F.length(text)))
    return (
        F.when(category.isin("Table", "Title", "List", "Code"), F.concat(F.lit(r"{\color{"), colour, F.lit("}"), text, F.lit("}")))
        .when(category.isin("Text", "Text-EQ"), F.concat(F.lit(r"{\textcolor{"), colour, F.lit("}{"), text, F.lit("}}")))
        .when(category.isin("Caption", "Footnote"), F.concat(head, F.lit(r"{\color{"), colour, F.lit("}"), rest, F.lit("}")))
        .when(category == "Algorithm", algorithm)
        .when(category == "PaperTitle", F.concat(head, F.lit(r"{\textcolor{"), colour, F.lit("}{"), rest, F.lit("}}")))
        .when(category == "Equation", F.concat(F.lit(r"{\color{"), colour, F.lit("}{"), text, F.lit("}}")))
        .when(category == "Abstract", F.concat(F.lit(r"{\begin{abstract}\color{"), colour, F.lit("}"), F.substring(text, F.lit(len(r"\begin{abstract}") + 1), F.length(text)), F.lit("}")))
    )


def definitions(rgb: str = "0, 0, 0") -> str:
    return "\n\\usepackage{xcolor}\n" + "".join(f"\\definecolor{{{name}_color}}{{RGB}}{{{rgb}}}\n" for _, name, _ in CATEGORIES)


def layout_messages(tag: str = LOG_TAG) -> str:
    return f"\\message{{[{tag}: Layout lengths]}}\n" + "".join(f"\\message{{[{tag}: The {k} is: \\the\\{k}]}}\n" for k in LAYOUT_KEYS)


def _before(text: Column, mark: str, new: str) -> Column:
    """new before the first mark; null where there is none."""
    at = F.locate(mark, text)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at, F.length(text))))


def add_color_definitions(text: Column) -> Column:
    return _before(text, r"\begin{document}", definitions())


def add_layout_messages(text: Column, tag: str = LOG_TAG) -> Column:
    return _before(text, r"\end{document}", layout_messages(tag))


def without_own_colours(text: Column) -> Column:
    """Link colours of hyperref off, listing styles gone."""
    uses = F.substring_index(text, r"\begin{document}", 1).rlike(r"(?d)\\usepackage(?:\[.*?\])?\{hyperref\}")
    plain = F.when(uses, _before(text, r"\begin{document}", "\\hypersetup{colorlinks=false}\n")).otherwise(text)
    return F.regexp_replace(plain, r"(?d)\\lstset\{.*?\}", "")


def whitened(text: Column) -> Column:
    """All category colours defined as white."""
    names = "|".join(name for _, name, _ in CATEGORIES)
    return F.regexp_replace(text, rf"\\definecolor\{{({names})_color\}}\{{RGB\}}\{{[^}}]*\}}", r"\\definecolor{$1_color}{RGB}{255, 255, 255}")


def styled(text: Column) -> Column:
    """The preamble of a coloured document."""
    return without_own_colours(add_layout_messages(add_color_definitions(text)))


def coloured(text: Column) -> Column:
    """Captions, footnotes, the title, the abstract, tables, code and algorithms in their colours."""
    out = T.with_groups(text, T.CAPTION_HEAD, r"{\color{Caption_color}", "}")
    for head in T.FOOTNOTE_HEADS.values():
        out = T.with_groups(out, head, r"{\color{Footnote_color}", "}")
    out = T.with_groups(out, T.TITLE_HEAD, r"{\textcolor{PaperTitle_color}{", "}}")
    out = F.regexp_replace(out, r"(?s)(\\begin\{abstract\})(.*?\\end\{abstract\})", r"{$1\\color{Abstract_color}$2}")
    out = F.regexp_replace(out, T.TABULAR, r"{\\color{Table_color}$0}")
    out = F.regexp_replace(out, T.CODE, r"{\\color{Code_color}$0}")
    return F.regexp_replace(out, r"(?s)(\\begin\{algorithm[*]?\}[^\\]*)(.*?)(\\end\{algorithm[*]?\})", r"$1{\\color{Algorithm_color}$2}$3")


def rendered(docs: DataFrame) -> DataFrame:
    """doc_id, tex, error: documents in which the mentions of all categories have their colour.

    Headings, lists, equations and texts are coloured in the parsed main content, which takes the old one's place; the others in the
    whole text after that. A document without a main content, or one that cannot be parsed, has no tex but an error.
    """
    content, start, stop = T.main_content("tex")
    parts = docs.select("doc_id", "tex", content.alias("_content"), start.alias("_start"), stop.alias("_stop"))
    found = categorised(parse_segments(parts.where("_content is not null").select("doc_id", F.col("_content").alias("tex"))))
    new = F.coalesce(colorize(F.col("text"), F.col("category")), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("seg_pos", new.alias("t"))))
    whole = found.groupBy("doc_id").agg(F.array_join(F.transform(ordered, lambda x: F.coalesce(x["t"], F.lit(""))), "").alias("_new"), F.max("error").alias("_error"))
    joined = parts.join(whole, "doc_id", "left")
    error = F.when(F.col("_content").isNull(), F.lit("no main content")).otherwise(F.col("_error"))
    spliced = T.spliced(F.col("tex"), F.col("_start"), F.col("_stop"), F.coalesce("_new", F.lit("")))
    return joined.select("doc_id", F.when(error.isNull(), coloured(spliced)).alias("tex"), error.alias("error"))


_ORDER = rf"\\(?:text)?color\{{({'|'.join(sorted((n for _, n, _ in CATEGORIES), key=len, reverse=True))})_color\}}"


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, tex, seq, category, mark, and lengths of all gaps and commands: a row for each colour command of a mention."""
    gaps = F.transform(F.split("tex", _ORDER, -1), F.length)
    listed = docs.select("doc_id", "tex", gaps.alias("gaps"), T.every("tex", _ORDER, 0).alias("marks"))
    listed = listed.withColumn("_all", F.transform("marks", lambda x: F.regexp_extract(x, _ORDER, 1)))
    rows = listed.select("doc_id", "tex", "gaps", F.transform("marks", F.length).alias("lengths"), F.col("_all"), F.posexplode("marks").alias("seq", "mark"))
    return rows.select("doc_id", "tex", "gaps", "lengths", "_all", F.col("seq").cast("long").alias("seq"), F.get("_all", F.col("seq")).alias("category"), "mark")


def mention_order(docs: DataFrame) -> DataFrame:
    """doc_id, seq, category, idx: coloured mentions in document order; idx counts those of its category before it. Definitions are none."""
    rows = docs.select("doc_id", F.posexplode(T.every("tex", _ORDER, 1)).alias("seq", "category")).withColumn("seq", F.col("seq").cast("long"))
    before = Window.partitionBy("doc_id", "category").orderBy("seq")
    return rows.withColumn("idx", (F.row_number().over(before) - 1).cast("long"))


def patches(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, seq, category, idx, start, length, new: what each variant changes in its document, at an offset from 0.

    A document's text is not copied unless `keep` names tex. The places before a mention are added up for its row alone, so a
    row costs no more than the text that a variant holds.
    """
    seq = F.col("seq").cast("int")
    sums = lambda c, n: F.aggregate(F.slice(c, F.lit(1), n), F.lit(0), lambda a, x: a + x)
    start = sums("gaps", seq + 1) + sums("lengths", seq)
    idx = F.size(F.filter(F.slice("_all", F.lit(1), seq), lambda x: x == F.col("category")))
    new = F.regexp_replace("mark", r"\{.*", "{black}")
    return _marked(docs).select("doc_id", *keep, "seq", "category", idx.cast("long").alias("idx"), start.cast("long").alias("start"), F.length("mark").cast("long").alias("length"), new.alias("new"))


def variants(docs: DataFrame) -> DataFrame:
    """doc_id, seq, category, name, tex: for each mention the document with that mention in black. Nothing is shuffled."""
    name = F.format_string("paper_block__%05d_%s_%05d", F.col("seq"), F.col("category"), F.col("idx"))
    text = T.spliced(F.col("tex"), F.col("start"), F.col("start") + F.col("length"), F.col("new"))
    return patches(docs, ("tex",)).select("doc_id", "seq", "category", name.alias("name"), text.alias("tex"))
