"""Tables of the data model, and the fixed vocabularies that results depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BLOCKS = "doc_id bigint, block_id bigint, ann_pos bigint, category string, page_index bigint, x0 double, y0 double, x1 double, y1 double, parent_block bigint, source_code string"
ORDERS = "doc_id bigint, type string, from_id bigint, to_id bigint"
NODES = "pre int, post int, parent_pre int, depth int, slot string, ord int, kind string, name string, begin string, end string, text string, char_pos int"
TOKENS = "tok_pos int, char_pos int, category string, text string"
SEGMENTS = "seg_pos int, depth int, kind string, name string, text string"
SEARCH_RESULTS = "entry_id string, updated string, published string, title string, doi string, authors array<string>, summary string, journal_ref string, primary_category string, categories array<string>, links array<string>, pdf_url string"
PAPERS = SEARCH_RESULTS + ", paper_id string, paper_path string, quality string"

# Layout categories as (id, name, supercategory).
CATEGORIES = [
    (0, "Algorithm", "Algorithm"), (1, "Caption", "Caption"), (2, "Equation", "Equation"), (3, "Figure", "Figure"), (4, "Footnote", "Footnote"),
    (5, "List", "List"), (6, "Others", "Others"), (7, "Table", "Table"), (8, "Text", "Text"), (9, "Text-EQ", "Text"), (10, "Title", "Title"),
    (11, "Reference", "Reference"), (12, "PaperTitle", "Title"), (13, "Code", "Algorithm"), (14, "Abstract", "Text"),
]

# The colour that a category's boxes are drawn in, by category id.
BOX_COLOURS = ["magenta", "cyan", "yellow", "blue", "green", "red", "teal", "purple", "orange", "brown", "pink", "olive", "pink", "magenta", "brown"]

# Categories that reading order sorts, by their part in it.
TITLE_LIKE = ["Title", "PaperTitle", "Abstract"]
TEXT_LIKE = ["Text", "Text-EQ", "Equation", "List"]
FOOTNOTE = "Footnote"
SORTABLE = ["PaperTitle", "Abstract", "Title", "Text", "Text-EQ", "Equation", "Footnote", "List"]
#: Mentions of these never cross a column.
ONE_COLUMN = ["Table", "Caption", "Algorithm", "PaperTitle", "Title"]

# Environment and command names by what they stand for.
MATH_ENVS = "equation equation* align align* $$ displaymath math gather gather* flalign flalign* falign* multline multline* alignat alignat* split eqnarray eqnarray* subequations chem chem* ceqn ceqn*".split()
INLINE_MATH = ["$", "math"]
TABLES_OF_CONTENTS = "tableofcontents listoffigures listoftables listofalgorithms lstlistoflistings".split()
SECTIONS = "chapter chapter* subsubsection subsubsection* subsection subsection* section* section".split()
TABULARS = "tabular tabular* tabularx tabulary tabu".split()
ALGORITHMS = "algorithm algorithm* algorithmic algorithmic* program pseudocode verbatim verbatim* lstlisting lstinputlisting".split()
LISTS = "itemize enumerate description".split()
FOOTNOTES = "footnote footnotetext tablefootnote".split()
INLINE_COMMANDS = "cite citet citet* citep citep* citealt citealt* citealp citealp* citeauthor citeauthor* citeyear citeyearpar eqref ref emph textbf textit textsc textsl texttt textup".split() + FOOTNOTES
OPAQUE_ENVS = ["thebibliography", "abstract"]
TEXT_ENVS = "theorem observation thm definition lemma remark corollary proposition example proof axiom conjecture exercise question solution quote note assumption fact justify acknowledgements flushleft flushright appendices IEEEproof widetext center".split()

#: Environments in which a percent sign is no comment.
VERBATIM_ENVS = "verbatim verbatim* Verbatim Verbatim* lstlisting lstlisting* verbatimtab listing".split()

# TeX lengths that layout metrics are made of, and references' commands.
LAYOUT_KEYS = "columnwidth columnsep textwidth paperwidth hoffset voffset oddsidemargin evensidemargin marginparwidth marginparsep topmargin headheight headsep footskip textheight".split()
REFERENCES = "ref eqref pageref autoref vref cref labelcref".split()
POINTS_PER_INCH, PPI = 72.27, 72.0


def categories(spark: SparkSession) -> DataFrame:
    """The category dimension."""
    return spark.createDataFrame(CATEGORIES, "id int, name string, supercategory string")
