"""Tokens, brackets and environments of LaTeX as DataFrame operators: one pattern, running sums and windows, no Python.

Tokens are those of parse.lex. Opening and closing marks are paired by running depth: a closing mark with nothing open is
stray and leaves the depth at 0; on each level openings and closings take turns, so an opening's partner is the next mark of
its level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .parse import DELIMITERS, SIZES, VERBATIM

_DELIMITERS = "|".join(rf"\Q{d}\E" for d in DELIMITERS)
PUNCTUATION = rf"\\(?:{'|'.join(SIZES)})(?:{_DELIMITERS})"
#: One token each.
TOKEN = rf"\\[^A-Za-z\[\]()\x00\x7f]|%[^\n]*|\$\$|\$|\\[(\[)\]]|[\x00\x7f]+|(?:[ \t]*\n[ \t]*|[ \t]+)(?=[\\{{}}$\[\]%\n]|\z)|{PUNCTUATION}|\\[A-Za-z]+\*?|\\|[{{}}\[\]]|[^\\{{}}$\[\]%\x00\x7f]+"
_SPACER = r"\A(?:[ \t]*\n[ \t]*|[ \t]+)\z"
_MARKS = {"$$": "DisplayMath", "$": "Math", "{": "GroupBegin", "}": "GroupEnd", "[": "BracketBegin", "]": "BracketEnd", r"\(": "MathBegin", r"\[": "MathBegin", r"\)": "MathEnd", r"\]": "MathEnd", "\\": "Escape"}

#: Environments' bounds; verbatim ones are whole, and escaped characters and comments hide what they hold.
BOUND = rf"(?s)\\begin\s*\{{({'|'.join(sorted(VERBATIM, key=len, reverse=True))})\}}.*?\\end\s*\{{\1\}}|\\[^A-Za-z]|%[^\n]*|\\(begin|end)\s*\{{([^{{}}]*)\}}"


def category(text: Column, following: Column) -> Column:
    """The category of a token, by its text and the token after it (null at the end)."""
    found = F.when(F.lit(False), F.lit(""))
    for mark, name in _MARKS.items():
        found = found.when(text == mark, name)
    found = found.when(F.startswith(text, F.lit("%")), "Comment").when(text.rlike(r"\A[\x00\x7f]"), "Ignored")
    found = found.when(text.rlike(rf"\A{PUNCTUATION}\z"), "Punctuation").when(text.rlike(r"\A\\[A-Za-z]"), "Command").when(F.startswith(text, F.lit("\\")), "Escaped")
    before_mark = following.isNull() | ~following.rlike(r"\A[\x00\x7f]")
    return found.when(text.rlike(_SPACER) & before_mark, "Spacer").otherwise("Text")


def _running(rows: DataFrame, lengths: Column, by: str, name: str) -> DataFrame:
    """rows with the sum of the lengths before each."""
    before = Window.partitionBy("doc_id").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(lengths).over(before), F.lit(0)).cast("int"))


def lex(docs: DataFrame) -> DataFrame:
    """doc_id, tok_pos, char_pos, category, text: the tokens of parse.lex. docs: doc_id (each once), tex."""
    listed = docs.select("doc_id", F.regexp_extract_all("tex", F.lit(TOKEN), F.lit(0)).alias("_t"))
    both = F.arrays_zip(F.col("_t").alias("text"), F.slice("_t", F.lit(2), F.size("_t")).alias("next"))
    rows = listed.select("doc_id", F.posexplode(both).alias("tok_pos", "t")).select("doc_id", "tok_pos", category(F.col("t.text"), F.col("t.next")).alias("category"), "t.text")
    return _running(rows, F.length("text"), "tok_pos", "char_pos").select("doc_id", "tok_pos", "char_pos", "category", "text")


def paired(rows: DataFrame, keys: list[str], at: str, step: Column) -> DataFrame:
    """rows with level, the depth that an opening mark leads to or a closing one ends (0 if it is stray), and partner, the `at` of the mark it belongs to.

    step: 1 for an opening mark, -1 for a closing one, 0 for what only has a level.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_step", step).withColumn("_sum", F.sum("_step").over(upto))
    rows = rows.withColumn("_low", F.least(F.coalesce(F.min("_sum").over(before), F.lit(0)), F.lit(0)))
    stray = (F.col("_step") < 0) & (F.col("_sum") < F.col("_low"))
    depth = F.col("_sum") - F.least("_sum", "_low")
    rows = rows.withColumn("level", F.when(stray, 0).when(F.col("_step") < 0, depth + 1).otherwise(depth).cast("int"))
    # what is no mark, or stray, is kept out of the turns
    turn = Window.partitionBy(*keys, "level", F.col("_step") == 0).orderBy(at)
    other = F.when(F.col("_step") > 0, F.lead(F.when(F.col("_step") < 0, F.col(at))).over(turn)).when(F.col("_step") < 0, F.lag(F.when(F.col("_step") > 0, F.col(at))).over(turn))
    return rows.withColumn("partner", F.when(F.col("level") > 0, other)).drop("_step", "_sum", "_low")


def brackets(tokens: DataFrame) -> DataFrame:
    """doc_id, kind (group or bracket), char_pos, char_end: braces that close, and brackets that close within their group."""
    marks = tokens.where(F.col("category").isin("GroupBegin", "GroupEnd", "BracketBegin", "BracketEnd")).select("doc_id", "char_pos", "category")
    braces = paired(marks, ["doc_id"], "char_pos", F.when(F.col("category") == "GroupBegin", 1).when(F.col("category") == "GroupEnd", -1).otherwise(0))
    groups = braces.where("category = 'GroupBegin' and partner is not null").select("doc_id", F.lit("group").alias("kind"), "char_pos", (F.col("partner") + 1).alias("char_end"))
    # a group's brackets have its level, and come after its brace and before the next one of the level; a stray brace parts those outside all groups
    parts = (F.col("category") == "GroupBegin") | (F.col("category") == "GroupEnd") & (F.col("level") == 0)
    level = Window.partitionBy("doc_id", "level").orderBy("char_pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = braces.select("doc_id", "char_pos", "category", F.col("level").alias("group_level"), F.sum(parts.cast("int")).over(level).alias("group"))
    inside = paired(inside.where(F.col("category").isin("BracketBegin", "BracketEnd")), ["doc_id", "group_level", "group"], "char_pos", F.when(F.col("category") == "BracketBegin", 1).otherwise(-1))
    return groups.unionByName(inside.where("category = 'BracketBegin' and partner is not null").select("doc_id", F.lit("bracket").alias("kind"), "char_pos", (F.col("partner") + 1).alias("char_end")))


def environments(docs: DataFrame) -> DataFrame:
    """doc_id, name, char_pos, char_end, level, error: every environment; one that is not closed, or closed by another name, has an error and no end."""
    both = F.arrays_zip(
        F.split("tex", BOUND, -1).alias("gap"), F.regexp_extract_all("tex", F.lit(BOUND), F.lit(0)).alias("text"), F.regexp_extract_all("tex", F.lit(BOUND), F.lit(1)).alias("whole"),
        F.regexp_extract_all("tex", F.lit(BOUND), F.lit(2)).alias("side"), F.regexp_extract_all("tex", F.lit(BOUND), F.lit(3)).alias("name"))
    rows = docs.select("doc_id", F.posexplode(both).alias("k", "b")).select("doc_id", "k", "b.*").where("text is not null")
    rows = _running(rows, F.length("gap") + F.length("text"), "k", "_before").withColumn("char_pos", F.col("_before") + F.length("gap")).withColumn("char_end", F.col("char_pos") + F.length("text"))
    marks = rows.where("side <> '' or whole <> ''").select("doc_id", "side", F.when(F.col("whole") != "", F.col("whole")).otherwise(F.col("name")).alias("name"), "char_pos", "char_end")
    found = paired(marks, ["doc_id"], "char_pos", F.when(F.col("side") == "begin", 1).when(F.col("side") == "end", -1).otherwise(0))
    turn = Window.partitionBy("doc_id", "level", F.col("side") == "").orderBy("char_pos")
    found = found.withColumn("_name", F.lead("name").over(turn)).withColumn("_end", F.lead("char_end").over(turn))
    whole, stray = F.col("side") == "", F.col("side") == "end"
    error = F.when(stray, F.when(F.col("level") == 0, "ends nothing")).when(whole, None).when(F.col("partner").isNull(), "not closed").when(F.col("_name") != F.col("name"), F.concat(F.lit("closed by "), F.col("_name")))
    end = F.when(whole, F.col("char_end")).when(error.isNull(), F.col("_end"))
    return found.select("doc_id", "name", "char_pos", end.alias("char_end"), (F.col("level") + F.when(whole, 1).otherwise(0)).alias("level"), error.alias("error"), (stray & (F.col("level") > 0)).alias("_pair")).where("not _pair").drop("_pair")
