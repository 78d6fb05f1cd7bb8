"""Golden pairs and model comparisons of the text functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from texloom.functions import tex as T
from texloom.operators import colour, extract


def value(spark, text, column):
    return spark.createDataFrame([(1, text)], "doc_id int, tex string").select(column.alias("v")).head().v


def listed(spark, text, f):
    return [r.source_code for r in f(spark.createDataFrame([(1, text)], "doc_id int, tex string")).orderBy("idx").collect()]


@pytest.mark.parametrize(("text", "want"), [
    ("no math", False), (r"5\$ only", False), ("$a<b$", True), (r"\(a<b\)", True), (r"\begin{math}x\end{math}", True), (r"$x$ and 5\$", True), ("a $x\ny$", False), ("", False),
])
def test_is_text_eq(spark, text, want):
    assert value(spark, text, T.is_text_eq(F.col("tex"))) is want


@pytest.mark.parametrize(("f", "text", "want"), [
    (extract.captions, r"\caption{} \caption[]{} \caption{Rain by month\label{t:rain}}", [r"\caption{}", r"\caption[]{}", r"\caption{Rain by month\label{t:rain}}"]),
    (extract.footnotes, r"a\footnote{\url{x}} b\footnotesize{no} \footnotetext{t}", [r"\footnote{\url{x}}", r"\footnotetext{t}"]),
    (extract.paper_titles, r"\title{On the growth of reeds} \icmltitle{x} \title{b}", [r"\title{On the growth of reeds}", r"\title{b}"]),
    (extract.tabulars, "\\begin{tabular}a\\end{tabular}\\begin{tabularx}{b}\n\\end{tabularx}\\begin{tabular}\\includegraphics{f}\\end{tabular}", ["\\begin{tabular}a\\end{tabular}", "\\begin{tabularx}{b}\n\\end{tabularx}"]),
    (extract.graphics, r"\includegraphics{a.png}\includegraphics[height=3cm]{plots/rain.png}", [r"\includegraphics{a.png}", r"\includegraphics[height=3cm]{plots/rain.png}"]),
    (extract.codes, "\\begin{verbatim*}v\\end{verbatim*}\\lstinputlisting[l]{f}\\lstinputlisting{g}", ["\\begin{verbatim*}v\\end{verbatim*}", "\\lstinputlisting[l]{f}"]),
])
def test_mentions(spark, f, text, want):
    assert listed(spark, text, f) == want


@pytest.mark.parametrize(("category", "text", "want"), [
    ("PaperTitle", r"\title{On the growth of reeds}", r"\title{{\textcolor{PaperTitle_color}{On the growth of reeds}}}"),
    ("Caption", r"\caption[s]{C}", r"\caption[s]{{\color{Caption_color}C}}"),
    ("Footnote", r"\footnote{\url{x}}", r"\footnote{{\color{Footnote_color}\url{x}}}"),
    ("Table", r"\begin{tabular}a\end{tabular}", r"{\color{Table_color}\begin{tabular}a\end{tabular}}"),
    ("Abstract", r"\begin{abstract}a\end{abstract}", r"{\begin{abstract}\color{Abstract_color}a\end{abstract}}"),
    ("Algorithm", "\\begin{algorithm}[t]\n  \\caption{c} x\\end{algorithm}", "\\begin{algorithm}[t]\n  {\\color{Algorithm_color}\\caption{c} x}\\end{algorithm}"),
    ("Algorithm", "\\begin{algorithm*}\\State y\\end{algorithm*}", "\\begin{algorithm*}{\\color{Algorithm_color}\\State y}\\end{algorithm*}"),
    ("Equation", "$$x$$", r"{\color{Equation_color}{$$x$$}}"),
    ("Text", "t", r"{\textcolor{Text_color}{t}}"),
    ("Figure", "f", None),
])
def test_colorize(spark, category, text, want):
    assert value(spark, text, colour.colorize(F.col("tex"), F.lit(category))) == want


def test_preamble(spark):
    text = "\\documentclass{article}\\begin{document}\\end{document}"
    made = value(spark, text, colour.add_color_definitions(F.col("tex")))
    assert made.startswith("\\documentclass{article}\n\\usepackage{xcolor}\n\\definecolor{Algorithm_color}{RGB}{0, 0, 0}\n") and made.count("\\definecolor") == 15 and made.endswith("\\begin{document}\\end{document}")
    assert value(spark, text, colour.add_layout_messages(F.col("tex"))).count("\\message{") == 16
    assert value(spark, "no body", colour.add_color_definitions(F.col("tex"))) is None
    linked = "\\usepackage[a=b]{hyperref}\n\\lstset{style=s}\\begin{document}x"
    assert value(spark, linked, colour.without_own_colours(F.col("tex"))) == "\\usepackage[a=b]{hyperref}\n\\hypersetup{colorlinks=false}\n\\begin{document}x"


def test_replace_nth(spark):
    for n, want in ((0, "a b a b a"), (1, "X b a b a"), (3, "a b a b X"), (4, "a b a b a")):
        assert value(spark, "a b a b a", T.replace_nth(F.col("tex"), "a", "X", n)) == want


def test_random_texts_against_models(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(["a", " ", "\n", "\n\n", "%", "\\", "{", "}", "\\caption", "\\%"]) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, tex string")
    rows = df.select("doc_id", T.paragraphs(F.col("tex")).alias("p"), T.without_spare_blank_lines("tex").alias("b"), T.without_line_comments("tex").alias("c"), T.line_and_column(F.col("tex"), F.lit(9))[0].alias("l")).collect()
    for r in rows:
        t = texts[r.doc_id]
        assert r.p == [x for x in re.split(r"(\n\n)", t) if x]
        assert r.b == re.sub(r"\A\s*\n", "", re.sub(r"\n\s*\n", "\n\n", t))
        assert r.c == re.sub(r"(?<!\\)((?:\\\\)*)%[^\n]*", r"\1", t)
        assert r.l == t[:9].count("\n")
