"""Labels, references, and the relations they make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import tex as T
from ..sources.rounds import cut
from .extract import listed

#: Categories whose references cite, and how.
EXPLICIT, IMPLICIT = ["Text", "Text-EQ", "Table", "Algorithm"], ["Caption"]
#: Float environments, in the order in which a caption is given to one; the last wins.
FLOATS = ["Table", "Figure", "Algorithm"]


def labels(docs: DataFrame) -> DataFrame:
    return listed(docs, T.every("tex", T.LABEL, 1), name="label")


def references(docs: DataFrame) -> DataFrame:
    """Keys in order, duplicates kept, empty ones dropped."""
    return listed(docs, F.filter(T.every("tex", T.REFERENCE, 1), lambda x: x != ""), name="label")


def cross_references(blocks: DataFrame, labelled: DataFrame | None = None, cited: DataFrame | None = None) -> DataFrame:
    """doc_id, type, from_id, to_id of each reference to a label of another block; the last block with a label has it.

    blocks: doc_id, block_id, ann_pos, category, source_code; labelled: doc_id, block_id, ann_pos, label, by default the labels in the
    source; cited: doc_id, from_id, type, label, by default the references in the source.
    """
    if labelled is None:
        labelled = blocks.select("doc_id", "block_id", "ann_pos", F.explode(T.every("source_code", T.LABEL, 1)).alias("label"))
    if cited is None:
        cited = references_of(blocks, EXPLICIT + IMPLICIT)
    owners = labelled.groupBy("doc_id", "label").agg(F.max_by("block_id", F.struct("ann_pos", "block_id")).alias("to_id"))
    return cited.join(owners, ["doc_id", "label"]).select("doc_id", "type", "from_id", "to_id")


def references_of(blocks: DataFrame, categories: list[str]) -> DataFrame:
    """doc_id, from_id, type, label of the references in the source of blocks of these categories."""
    kind = F.when(F.col("category").isin(IMPLICIT), "implicit-cite").otherwise("explicit-cite")
    keys = F.explode(F.filter(T.every("source_code", T.REFERENCE, 1), lambda x: x != "")).alias("label")
    return blocks.where(F.col("category").isin(categories)).select("doc_id", F.col("block_id").alias("from_id"), kind.alias("type"), keys)


def title_labels(docs: DataFrame) -> DataFrame:
    """doc_id, idx, title, label: labels in a heading, and the first after it if only white space lies between."""
    # the heading's own braces may nest
    pattern = rf"(\\(?:sub)*section\*?{T.braces()}|\\chapter\*?{T.braces()})(?:\s*\\label\{{([^}}]*)\}})?"
    # one pass over the text; the parts are read from what it found
    part = lambda x, k: F.regexp_extract(x, pattern, k)
    pairs = F.transform(T.every("tex", pattern), lambda x: F.struct(part(x, 1).alias("title"), part(x, 2).alias("next")))
    rows = docs.select("doc_id", F.posexplode(pairs).alias("idx", "p"))
    found = F.filter(F.concat(T.every(F.col("p.title"), T.LABEL, 1), F.array(F.col("p.next"))), lambda x: x != "")
    return rows.select("doc_id", F.col("idx").cast("long").alias("idx"), F.col("p.title").alias("title"), F.explode(found).alias("label"))


def float_spans(docs: DataFrame) -> DataFrame:
    """doc_id, category, idx, span_start, span_end (offsets from 0), float_key, labels of each float environment; the documents are read once.

    A span is listed with the length of what lies before it, and a running sum over the spans of a document gives its place.
    """
    patterns = {c: rf"(?s)\\begin\{{{c.lower()}\*?\}}.*?\\end\{{{c.lower()}\*?\}}" for c in FLOATS}
    each = F.array(*(F.struct(F.lit(c).alias("category"), T.gapped("tex", p).alias("l")) for c, p in patterns.items()))
    rows = docs.select("doc_id", F.explode(each).alias("m")).select("doc_id", "m.category", F.posexplode("m.l").alias("idx", "v"))
    rows = rows.select("doc_id", "category", F.col("idx").cast("long").alias("idx"), F.col("v.gap").alias("gap"), F.length("v.text").alias("size"), T.every(F.col("v.text"), T.LABEL, 1).alias("labels"))
    upto = Window.partitionBy("doc_id", "category").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("span_end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("long"))
    rows = rows.select("doc_id", "category", "idx", (F.col("span_end") - F.col("size")).alias("span_start"), "span_end", "labels")
    return rows.withColumn("float_key", F.concat_ws(":", "category", "span_start"))


def located(mentions: DataFrame, docs: DataFrame) -> DataFrame:
    """mentions (doc_id, category, idx, source_code) with m_start and m_end, where their source occurs; those that do not occur go.

    Of equal mentions the first by idx stands where the source first occurs, the second where it occurs next, and so on. Mentions that
    extract.placed gives have their places already.
    """
    again = Window.partitionBy("doc_id", "category", "source_code").orderBy("idx")
    numbered = mentions.where("source_code <> ''").withColumn("_n", F.row_number().over(again))
    # the text before the n-th occurrence
    before = F.expr("substring_index(tex, source_code, _n)")
    there = F.length("tex") > F.length(before)
    found = numbered.hint("shuffle_hash").join(docs.select("doc_id", "tex"), "doc_id").where(there)  # texts are not sorted
    start = F.length(before).cast("long")
    return found.select(*mentions.columns, start.alias("m_start"), (start + F.length("source_code")).alias("m_end"))


def holders(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, m_category, m_idx, float_key, category, span_start, labels: each mention with every float environment that holds it.

    Floats of one category do not overlap, so only the last one that starts before a mention can hold it: places and spans are
    ordered together, and no pairs are made.
    """
    span = F.struct("span_start", "span_end", "float_key", "labels")
    a = spans.select("doc_id", "category", F.col("span_start").alias("at"), F.lit(0).alias("kind"), span.alias("span"), F.lit(None).cast("string").alias("m_category"), F.lit(None).cast("long").alias("m_idx"), F.lit(None).cast("long").alias("m_end"))
    each = F.explode(F.array(*map(F.lit, FLOATS)))
    b = mentions.select("doc_id", each.alias("category"), F.col("m_start").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(a.schema["span"].dataType).alias("span"), F.col("category").alias("m_category"), F.col("idx").alias("m_idx"), "m_end")
    before = Window.partitionBy("doc_id", "category").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = a.unionByName(b).withColumn("last", F.last("span", ignorenulls=True).over(before)).where("kind = 1 and m_end <= last.span_end")
    return found.select("doc_id", "m_category", "m_idx", "last.float_key", "category", "last.span_start", "last.labels")


def contained(mentions: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, m_category, idx, float_key, category, labels: each mention with the float that holds it, the last by category and start."""
    return innermost(holders(mentions, spans))


def innermost(held: DataFrame) -> DataFrame:
    """contained(), of what holders gives."""
    rank = F.struct(F.array_position(F.array(*map(F.lit, FLOATS)), F.col("category")).alias("c"), F.col("span_start").alias("s"))
    best = held.groupBy("doc_id", "m_category", "m_idx").agg(F.max_by(F.struct("float_key", "category", "labels"), rank).alias("b"))
    return best.select("doc_id", "m_category", F.col("m_idx").alias("idx"), "b.float_key", "b.category", F.array_join("b.labels", ",").alias("labels"))


def caption_relations(captions: DataFrame, bodies: DataFrame) -> DataFrame:
    """doc_id, float_key, caption_idx, body_category, body_idx: captions and bodies of the same float (implicit-cite)."""
    a = captions.select("doc_id", "float_key", F.col("idx").alias("caption_idx"))
    b = bodies.select("doc_id", "float_key", F.col("m_category").alias("body_category"), F.col("idx").alias("body_idx"))
    return a.join(b, ["doc_id", "float_key"])


def block_labels(blocks: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, block_id, ann_pos, label of blocks that carry labels; doc_id, from_id, type, label of captions' references to their float).

    Headings carry the labels in them and the one that follows; equations those in them; tables, figures and algorithms those of the
    float of their kind that holds them, and its key, which its captions refer to. Runs a job: floats and captions read one table of holders.
    """
    own = F.explode(T.every("source_code", T.LABEL, 1)).alias("label")
    equations = blocks.where("category = 'Equation'").select("doc_id", "block_id", "ann_pos", own)
    # a heading that occurs twice stands where it occurs first
    headings = title_labels(docs)
    first = Window.partitionBy("doc_id", "title")
    headings = headings.withColumn("_first", F.min("idx").over(first)).where("idx = _first").select("doc_id", F.col("title").alias("source_code"), "label")
    titles = blocks.where("category = 'Title'").join(headings, ["doc_id", "source_code"]).select("doc_id", "block_id", "ann_pos", "label")
    inner = blocks.where(F.col("category").isin(FLOATS + IMPLICIT)).select("doc_id", "category", F.col("block_id").alias("idx"), "ann_pos", "source_code")
    held = cut(holders(located(inner, docs), float_spans(docs)), "holders")
    bodies = held.where("category = m_category").join(blocks.select("doc_id", F.col("block_id").alias("m_idx"), "ann_pos"), ["doc_id", "m_idx"])
    floats = bodies.select("doc_id", F.col("m_idx").alias("block_id"), "ann_pos", F.explode(F.array_append("labels", F.col("float_key"))).alias("label"))
    captions = innermost(held.where(F.col("m_category").isin(IMPLICIT)))
    cites = captions.select("doc_id", F.col("idx").alias("from_id"), F.lit("implicit-cite").alias("type"), F.col("float_key").alias("label"))
    return titles.unionByName(equations).unionByName(floats), cites


def float_and_cross_references(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, type, from_id, to_id: captions to the bodies of their floats, and texts, tables and algorithms to what they refer to."""
    labelled, cites = block_labels(blocks, docs)
    return cross_references(blocks, labelled, cites.unionByName(references_of(blocks, EXPLICIT)))
