"""Queries over parsed documents (nested-set rows of parse.parse_nodes), all native.

A node's descendants are those with a pre number between its own and a smaller post number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.tex import gapped


def find_all(nodes: DataFrame, names: list[str] | str) -> DataFrame:
    """Commands and environments of these names."""
    names = [names] if isinstance(names, str) else names
    return nodes.where(F.col("name").isin(names) & F.col("kind").isin("cmd", "env", "math", "item"))


def find(nodes: DataFrame, names: list[str] | str) -> DataFrame:
    """The first of them in each document: doc_id and the columns of nodes."""
    found = find_all(nodes, names)
    first = found.groupBy("doc_id").agg(F.min_by(F.struct(*[c for c in nodes.columns if c != "doc_id"]), "pre").alias("n"))
    return first.select("doc_id", "n.*")


def count(nodes: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, name, n."""
    return find_all(nodes, names).groupBy("doc_id", "name").agg(F.count("*").alias("n"))


def children(nodes: DataFrame, parents: DataFrame, texts: bool = True, blank: bool = False) -> DataFrame:
    """Contents of parents (doc_id, pre): direct ones, without arguments; texts and blank texts only if asked for."""
    p = parents.select("doc_id", F.col("pre").alias("parent_pre"))
    found = nodes.join(p, ["doc_id", "parent_pre"]).where("slot = 'content'")
    found = found if texts else found.where("kind <> 'text'")
    return found if blank else found.where((F.col("kind") != "text") | F.col("text").rlike(r"(?U)\S"))


def descendants(nodes: DataFrame, of: DataFrame) -> DataFrame:
    """of_pre and the columns of nodes for everything below `of` (doc_id, pre, post, depth).

    A node has post - pre + depth descendants, and their pre numbers follow its own. One sweep over a document's nodes and
    the starts and ends of `of` counts the nodes passed, so that each of `of` knows the run of them that lies below it; the
    runs are joined by place. The work is that of the rows returned, not of all pairs, and no key holds more than one row.
    """
    cols = nodes.columns
    starts, stops = F.col("pre"), F.col("post") + F.col("depth")
    marks = nodes.select("doc_id", F.col("pre").alias("at"), F.lit(0).alias("side"), F.lit(None).cast("int").alias("of_pre"))
    for side, at in ((1, starts), (2, stops)):
        marks = marks.unionByName(of.select("doc_id", at.alias("at"), F.lit(side).alias("side"), F.col("pre").alias("of_pre")))
    swept = Window.partitionBy("doc_id").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    passed = marks.select("doc_id", "side", "of_pre", F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).over(swept).alias("n"))
    runs = passed.where("side > 0").groupBy("doc_id", "of_pre").agg(F.min("n").alias("first"), F.max("n").alias("last")).where("last > first")
    places = runs.select("doc_id", "of_pre", F.explode(F.sequence(F.col("first") + 1, F.col("last"))).alias("_place"))
    placed = nodes.withColumn("_place", F.row_number().over(Window.partitionBy("doc_id").orderBy("pre")).cast("long"))
    return placed.join(places, ["doc_id", "_place"]).select("of_pre", *cols)


def enclosing(nodes: DataFrame, of: DataFrame) -> DataFrame:
    """doc_id, pre, of_pre: the innermost of `of` that each node lies in, if any; a row for each node that has one."""
    found = descendants(nodes, of)
    return found.groupBy("doc_id", "pre").agg(F.max("of_pre").alias("of_pre"))


def texts(nodes: DataFrame) -> DataFrame:
    """doc_id, pre, text of the text leaves."""
    return nodes.where("kind = 'text'").select("doc_id", "pre", "text", "char_pos")


def search(nodes: DataFrame, pattern: str) -> DataFrame:
    """doc_id, pre, idx, body, position (offset in the document) of each match of a pattern within a text leaf."""
    rows = texts(nodes).select("doc_id", "pre", "char_pos", F.posexplode(gapped("text", pattern)).alias("idx", "m"))
    upto = Window.partitionBy("doc_id", "pre").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.length("m.text")).over(upto)
    return rows.withColumn("_end", end).select("doc_id", "pre", F.col("idx").cast("long").alias("idx"), F.col("m.text").alias("body"), (F.col("char_pos") + F.col("_end") - F.length("m.text")).cast("long").alias("position"))


def source(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """nodes with source, the text that each spans. A document's text meets all its nodes in one row, so it isn't copied to each of them; nodes are read once. Nodes that were parsed with their sources keep those, and docs is not read."""
    if "source" in nodes.columns:
        return nodes.select(*(c for c in nodes.columns if c != "source"), "source")
    own = [c for c in nodes.columns if c != "doc_id"]
    spans = nodes.where("pre is not null").groupBy("doc_id").agg(F.collect_list(F.struct(*own)).alias("_s"))
    cut_ = F.transform("_s", lambda x: F.struct(x.alias("n"), F.substring(F.col("tex"), x["char_pos"] + 1, x["char_end"] - x["char_pos"]).alias("source")))
    found = docs.select("doc_id", "tex").join(spans, "doc_id").select("doc_id", F.explode(cut_).alias("c"))
    return found.select(*("doc_id" if c == "doc_id" else f"c.n.{c}" for c in nodes.columns), "c.source")


def positions(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, pre, line and column (from 0) of each node: one sweep over a document's line starts and the nodes' offsets."""
    lines = docs.select("doc_id", F.posexplode(F.split("tex", "\n", -1)).alias("line", "_text"))
    before = Window.partitionBy("doc_id").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.select("doc_id", F.coalesce(F.sum(F.length("_text") + 1).over(before), F.lit(0)).alias("at"), F.lit(0).alias("side"), F.col("line"), F.lit(None).cast("int").alias("pre"))
    both = starts.unionByName(nodes.select("doc_id", F.col("char_pos").cast("bigint").alias("at"), F.lit(1).alias("side"), F.lit(None).cast("int").alias("line"), "pre"))
    upto = Window.partitionBy("doc_id").orderBy("at", "side", "line").rowsBetween(Window.unboundedPreceding, 0)
    line = F.last(F.when(F.col("side") == 0, F.struct("line", "at")), ignorenulls=True).over(upto)
    return both.withColumn("_l", line).where("side = 1").select("doc_id", "pre", F.col("_l.line").cast("long").alias("line"), (F.col("at") - F.col("_l.at")).cast("long").alias("column"))


def _edited(docs: DataFrame, spans: DataFrame, new: Column) -> DataFrame:
    """docs with spans (doc_id, char_pos, char_end, none inside another) replaced by new, a column of spans."""
    edits = spans.select("doc_id", F.struct("char_pos", "char_end", new.alias("new")).alias("e")).groupBy("doc_id").agg(F.array_sort(F.collect_list("e")).alias("_e"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, e: F.struct(e["char_end"].alias("at"), F.concat(a["out"], F.substring(F.col("tex"), a["at"] + 1, e["char_pos"] - a["at"]), e["new"]).alias("out"))
    last = lambda a: F.concat(a["out"], F.substring(F.col("tex"), a["at"] + 1, F.length("tex")))
    return docs.join(edits, "doc_id", "left").select("doc_id", F.when(F.col("_e").isNull(), F.col("tex")).otherwise(F.aggregate("_e", start, step, last)).alias("tex"))


def removed(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs without the nodes found."""
    return _edited(docs, found, F.lit(""))


def replaced(docs: DataFrame, found: DataFrame, new: Column) -> DataFrame:
    """docs with each node found replaced by new, a column over found."""
    return _edited(docs, found, new)


def copied(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with each node found standing twice; none may lie inside another."""
    copies = source(found, docs)
    return _edited(docs, copies.withColumn("char_pos", F.col("char_end")), F.col("source"))


def string(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, pre, string: the text of a command with one argument, or of an environment whose content is one text; others have none."""
    one = arguments(nodes, docs).where(F.size("args") == 1).select("doc_id", "pre", F.col("args")[0]["text"].alias("string"))
    inner = nodes.where("slot = 'content' and parent_pre is not null").groupBy("doc_id", F.col("parent_pre").alias("pre")).agg(F.count("*").alias("n"), F.max("kind").alias("kind"), F.max("text").alias("string"))
    envs = nodes.where("kind in ('env', 'math', 'group', 'bracket')").select("doc_id", "pre")
    return one.unionByName(inner.where("n = 1 and kind = 'text'").join(envs, ["doc_id", "pre"]).select("doc_id", "pre", "string"))


def with_string(docs: DataFrame, nodes: DataFrame, found: DataFrame, new: Column) -> DataFrame:
    """docs with the one argument of each command found, or the content of each environment found, replaced by new, a column of found."""
    mine = found.select("doc_id", F.col("pre").alias("parent_pre"), "kind", F.length("begin").alias("_begin"), F.length("end").alias("_end"), F.col("char_pos").alias("_from"), F.col("char_end").alias("_to"), new.alias("_new"))
    args = nodes.where("slot = 'arg'").groupBy("doc_id", "parent_pre").agg(F.count("*").alias("n"), F.min("char_pos").alias("a"), F.max("char_end").alias("b")).where("n = 1")
    commands = mine.where("kind = 'cmd'").join(args, ["doc_id", "parent_pre"]).select("doc_id", (F.col("a") + 1).alias("char_pos"), (F.col("b") - 1).alias("char_end"), "_new")
    envs = mine.where("kind <> 'cmd'").select("doc_id", (F.col("_from") + F.col("_begin")).alias("char_pos"), (F.col("_to") - F.col("_end")).alias("char_end"), "_new")
    return _edited(docs, commands.unionByName(envs), F.col("_new"))


def inserted_before(docs: DataFrame, found: DataFrame, new: Column) -> DataFrame:
    return _edited(docs, found.withColumn("char_end", F.col("char_pos")), new)


def appended(docs: DataFrame, found: DataFrame, new: Column) -> DataFrame:
    """docs with new before the end of each environment found."""
    at = F.col("char_end") - F.length("end")
    return _edited(docs, found.withColumn("char_pos", at).withColumn("char_end", at), new)


def arguments(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, pre, args: the arguments of each command as kind and text, in order."""
    spans = source(nodes.where("slot = 'arg'"), docs)
    args = F.array_sort(F.collect_list(F.struct("ord", "kind", F.expr("substring(source, 2, length(source) - 2)").alias("text"))))
    return spans.groupBy("doc_id", F.col("parent_pre").alias("pre")).agg(F.transform(args, lambda x: F.struct(x["kind"].alias("kind"), x["text"].alias("text"))).alias("args"))
