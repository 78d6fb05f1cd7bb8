"""Environment mentions: one row for each occurrence, in document order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions import tex as T
from .lexer import environments
from .records import statuses


def listed(docs: DataFrame, values: Column, *, name: str = "source_code", kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A row for each element of an array column, with idx, its place from 0."""
    return docs.select(*kept, F.posexplode(values).alias("idx", name)).withColumn("idx", F.col("idx").cast("long"))


def _footnotes() -> Column:
    """All of one command before the next, as the commands are listed."""
    return F.concat(*(T.groups("tex", head) for head in T.FOOTNOTE_HEADS.values()))


def _tabulars() -> Column:
    """Tables' bodies, without those that hold graphics."""
    return F.filter(T.every("tex", T.TABULAR), lambda x: ~F.contains(x, F.lit(r"\includegraphics")))


def _graphics() -> Column:
    r"""\includegraphics commands, rebuilt from options and path."""
    pair = F.arrays_zip(T.every("tex", T.GRAPHICS, 1).alias("o"), T.every("tex", T.GRAPHICS, 2).alias("p"))
    options = lambda x: F.when(x["o"] != "", F.concat(F.lit("["), x["o"], F.lit("]"))).otherwise("")
    return F.transform(pair, lambda x: F.concat(F.lit(r"\includegraphics"), options(x), F.lit("{"), x["p"], F.lit("}")))


#: category -> its mentions in tex, in order.
LISTS: dict[str, Callable[[], Column]] = {
    "Caption": lambda: T.groups("tex", T.CAPTION_HEAD), "PaperTitle": lambda: T.groups("tex", T.TITLE_HEAD), "Footnote": _footnotes, "Table": _tabulars,
    "Algorithm": lambda: T.every("tex", T.ALGORITHM), "Code": lambda: T.every("tex", T.CODE), "Figure": _graphics,
}


def captions(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Caption"]())


def paper_titles(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["PaperTitle"]())


def footnotes(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Footnote"]())


def abstracts(docs: DataFrame) -> DataFrame:
    """doc_id, source_code, status: a document with several abstracts has status 'multiple' and no source."""
    found = docs.select("doc_id", T.every("tex", T.ABSTRACT).alias("all"))
    return found.where(F.size("all") > 0).select("doc_id", F.when(F.size("all") == 1, F.get("all", F.lit(0))).alias("source_code"), F.when(F.size("all") == 1, "ok").otherwise("multiple").alias("status"))


def tabulars(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Table"]())


def algorithms(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Algorithm"]())


def codes(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Code"]())


def graphics(docs: DataFrame) -> DataFrame:
    return listed(docs, LISTS["Figure"]())


def text_paragraphs(docs: DataFrame) -> DataFrame:
    """Non-blank paragraphs of tex, as Text or Text-EQ."""
    found = docs.select("doc_id", F.posexplode(T.paragraphs(F.col("tex"))).alias("idx", "source_code")).where(F.col("source_code").rlike(r"(?U)\S"))
    return found.select("doc_id", F.col("idx").cast("long").alias("idx"), F.when(T.is_text_eq(F.col("source_code")), "Text-EQ").otherwise("Text").alias("category"), "source_code")


def mentions(docs: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """doc_id, category, idx, source_code of every category that patterns find, or of some; the documents are read once. Several abstracts are none."""
    abstract = T.every("tex", T.ABSTRACT)
    lists = {c: f() for c, f in LISTS.items()} | {"Abstract": F.when(F.size(abstract) == 1, abstract).otherwise(F.array().cast("array<string>"))}
    each = F.array(*(F.struct(F.lit(c).alias("category"), v.alias("l")) for c, v in lists.items() if categories is None or c in categories))
    rows = docs.select("doc_id", F.explode(each).alias("m")).select("doc_id", "m.category", F.posexplode("m.l").alias("idx", "source_code"))
    return rows.withColumn("idx", F.col("idx").cast("long")).select("doc_id", "category", "idx", "source_code")


#: category -> lists of its mentions with the gaps before them; idx counts on from list to list.
PLACES: dict[str, Callable[[], list[Column]]] = {
    "Caption": lambda: [T.gapped_groups("tex", T.CAPTION_HEAD)], "PaperTitle": lambda: [T.gapped_groups("tex", T.TITLE_HEAD)], "Footnote": lambda: [T.gapped_groups("tex", head) for head in T.FOOTNOTE_HEADS.values()],
    "Table": lambda: [T.gapped("tex", T.TABULAR)], "Algorithm": lambda: [T.gapped("tex", T.ALGORITHM)], "Code": lambda: [T.gapped("tex", T.CODE)],
}


def placed(docs: DataFrame, categories: list[str]) -> DataFrame:
    """doc_id, category, idx, source_code, m_start, m_end: mentions with the offsets (from 0) at which they stand, equal ones each at its own."""
    each = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(k).alias("part"), v.alias("l")) for c in categories for k, v in enumerate(PLACES[c]())))
    rows = docs.select("doc_id", F.explode(each).alias("m")).select("doc_id", "m.category", "m.part", F.posexplode("m.l").alias("_k", "g"))
    rows = rows.select("doc_id", "category", "part", "_k", F.col("g.gap").alias("_gap"), F.col("g.text").alias("source_code"))
    upto = Window.partitionBy("doc_id", "category", "part").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("m_end", F.sum(F.col("_gap") + F.length("source_code")).over(upto).cast("long"))
    # tables that hold graphics count as text between the others
    rows = rows.where((F.col("category") != "Table") | ~F.contains("source_code", F.lit(r"\includegraphics")))
    place = Window.partitionBy("doc_id", "category").orderBy("part", "_k")
    rows = rows.withColumn("idx", (F.row_number().over(place) - 1).cast("long"))
    return rows.select("doc_id", "category", "idx", "source_code", (F.col("m_end") - F.length("source_code")).alias("m_start"), "m_end")


def mention_map(mentioned: DataFrame) -> DataFrame:
    """doc_id, texts: category -> its mentions in order."""
    by = mentioned.groupBy("doc_id", "category").agg(F.array_sort(F.collect_list(F.struct("idx", "source_code"))).alias("l"))
    return by.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", F.transform("l", lambda x: x["source_code"]))))).alias("texts"))


#: category -> heads whose brace group must close.
HEADS = {"Caption": [T.CAPTION_HEAD], "PaperTitle": [T.TITLE_HEAD], "Footnote": list(T.FOOTNOTE_HEADS.values())}


def _errors() -> Column:
    """What keeps mentions of tex from being found, as texts."""

    def said(category: str, head: str) -> Column:
        return F.transform(T.unclosed("tex", head), lambda k: F.format_string(f"{category} at %d: not closed", k))

    parts = [said(category, head) for category, heads in HEADS.items() for head in heads]
    return F.concat(*parts, F.when(F.size(T.every("tex", T.ABSTRACT)) > 1, F.array(F.lit("Abstract: several"))).otherwise(F.array().cast("array<string>")))


def with_errors(docs: DataFrame) -> tuple[DataFrame, Observation]:
    """docs with errors, an array of texts, and an observation of how many documents pass (documents) and how many have some (failed); it is there after any action on the table."""
    seen = Observation("extraction")
    return docs.withColumn("errors", F.coalesce(_errors(), F.array().cast("array<string>"))).observe(seen, F.count(F.lit(1)).alias("documents"), F.count_if(F.size("errors") > 0).alias("failed")), seen


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, error: a row for each head that never closes, and for documents of several abstracts."""
    return docs.select("doc_id", F.explode(_errors()).alias("error"))


def document_statuses(docs: DataFrame) -> DataFrame:
    """doc_id, status, error: one row for each document; failed ones have the first of their errors by name."""
    return statuses(docs, docs, failures(docs), "doc_id")


def by_dictionary(docs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """doc_id, category, idx, name, source_code of the environments that a dictionary names. dictionary: name, category, ord.

    A name that stands for several categories stands for the first by ord. What a mention holds is no mention of its own;
    idx counts those of a category. The dictionary is a table of the user's: it is joined by name, whatever its size.
    """
    first = dictionary.where("name is not null").groupBy("name").agg(F.min_by("category", F.struct("ord", "category")).alias("category"))
    found = environments(docs).where("error is null").join(first, "name").select("doc_id", "category", "name", "char_pos", "char_end")
    before = Window.partitionBy("doc_id").orderBy("char_pos").rowsBetween(Window.unboundedPreceding, -1)
    outer = found.withColumn("_reach", F.coalesce(F.max("char_end").over(before), F.lit(0))).where("char_pos >= _reach").drop("_reach")
    place = Window.partitionBy("doc_id", "category").orderBy("char_pos")
    numbered = outer.withColumn("idx", (F.row_number().over(place) - 1).cast("long"))
    return numbered.join(docs.select("doc_id", "tex"), "doc_id").select("doc_id", "category", "idx", "name", F.substring("tex", F.col("char_pos") + 1, F.col("char_end") - F.col("char_pos")).alias("source_code"))
