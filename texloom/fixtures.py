"""Inputs derived from the driver's tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import table

#: LaTeX documents with the usual environments.
TEX_DOCS = """select doc_id, concat(
 chr(92),'documentclass{article}',chr(10),chr(92),'title{T ',source,'}',chr(10),
 chr(92),'begin{document}',chr(10),
 case when doc_id % 4 <> 0 then concat(chr(92),'begin{abstract}',chr(10),substr(text,1,120),chr(10),chr(92),'end{abstract}',chr(10)) else '' end,
 chr(92),'section{S',cast(doc_id % 7 as varchar(9)),'}',chr(10),chr(92),'label{sec:',cast(doc_id % 7 as varchar(9)),'}',chr(10),chr(10),
 text,' cost $x_',cast(doc_id % 3 as varchar(9)),'$',chr(10),chr(10),
 case when doc_id % 5 <> 0 then concat(chr(92),'begin{equation}',chr(92),'label{eq:',cast(doc_id % 5 as varchar(9)),'}a=b',chr(92),'end{equation}',chr(10)) else '' end,
 'See ',chr(92),'eqref{eq:',cast(doc_id % 5 as varchar(9)),'} and ',chr(92),'ref{tab:',cast(doc_id % 6 as varchar(9)),'}.',chr(10),chr(10),
 case when doc_id % 2 = 0 then concat(chr(92),'begin{table}[h]',chr(92),'begin{tabular}{c c}',chr(10),'1 & 2',chr(92),chr(92),chr(10),chr(92),'end{tabular}',chr(92),'caption[s]{C {n {m}} ',source,'}',chr(92),'label{tab:',cast(doc_id % 6 as varchar(9)),'}',chr(92),'end{table}',chr(10)) else '' end,
 case when doc_id % 3 = 0 then concat(chr(92),'begin{figure}',chr(92),'includegraphics[width=1cm]{f',cast(doc_id as varchar(19)),'.png}',chr(92),'caption{F}',chr(92),'end{figure}',chr(10)) else '' end,
 case when doc_id % 2 = 1 then concat('x',chr(92),'footnote{N ',chr(92),'url{u}}',chr(10)) else '' end,
 case when doc_id % 8 = 0 then concat(chr(92),'begin{comment}',chr(10),'hidden',chr(10),chr(92),'end{comment}',chr(10)) else '' end,
 chr(92),'begin{itemize}',chr(10),chr(92),'item a',chr(10),chr(92),'item b',chr(10),chr(92),'end{itemize}',chr(10),
 case when doc_id % 9 = 0 then concat(chr(92),'begin{verbatim}',chr(10),'code',chr(10),chr(92),'end{verbatim}',chr(10)) else '' end,
 chr(92),'end{document}',chr(10)) as tex from documents"""

#: The rarer commands: contents lists, old figure macros, hyperref, algorithms, listings, line comments.
MORE_DOCS = """select doc_id, concat(
 chr(92),'documentclass{article}',chr(10),
 case when doc_id % 3 = 0 then concat(chr(92),'usepackage[colorlinks=true]{hyperref}',chr(10)) when doc_id % 3 = 1 then concat(chr(92),'usepackage{hyperref}',chr(10)) else '' end,
 case when doc_id % 4 = 0 then concat(chr(92),'graphicspath{{figs/}{more/}}',chr(10)) else '' end,
 case when doc_id % 5 = 0 then concat(chr(92),'lstset{style=plain}',chr(10)) else '' end,
 chr(92),'begin{document}',chr(10),chr(92),'tableofcontents',chr(10),
 case when doc_id % 2 = 0 then concat(chr(92),'listoffigures',chr(10)) else '' end,
 chr(10),chr(10),'  ',chr(10),chr(10),text,' % note ',cast(doc_id as varchar(19)),' ',chr(92),'begin{verbatim}',chr(10),'50',chr(92),'% kept ',chr(92),'verb|%x| % gone',chr(10),
 chr(92),'psfig{fig',cast(doc_id % 9 as varchar(9)),'.ps} ',chr(92),'epsfig{g.eps}',chr(10),
 chr(92),'includegraphics{h',cast(doc_id % 4 as varchar(9)),'} ',chr(92),'includegraphics[scale=2]{h',cast(doc_id % 5 as varchar(9)),'.pdf}',chr(10),
 case when doc_id % 2 = 0 then concat(chr(92),'begin{algorithm}[!htb]',chr(10),' ',chr(92),'caption{A}',chr(92),'label{alg:',cast(doc_id % 6 as varchar(9)),'} x',chr(92),'end{algorithm}',chr(10)) else concat(chr(92),'begin{algorithm*}',chr(10),' ',chr(92),'State y',chr(92),'end{algorithm*}',chr(10)) end,
 case when doc_id % 3 = 0 then concat(chr(92),'lstinputlisting[language=C]{a.c}',chr(10)) when doc_id % 3 = 1 then concat(chr(92),'begin{lstlisting}',chr(10),'int a; % stays',chr(10),chr(92),'end{lstlisting}',chr(10)) else concat(chr(92),'begin{verbatim*}',chr(10),'v 50% v',chr(10),chr(92),'end{verbatim*}',chr(10)) end,
 chr(92),'begin{table*}',chr(92),'label{t:a}',chr(92),'begin{tabularx}{1cm}{c}1',chr(92),'end{tabularx}',chr(92),'caption{B}',chr(92),'label{t:',cast(doc_id as varchar(19)),'}',chr(92),'end{table*}',chr(10),
 case when doc_id % 4 = 1 then concat(chr(92),'begin{tabular}{c}',chr(92),'includegraphics{q}',chr(92),'end{tabular}',chr(10)) else '' end,
 chr(92),'section{Next}',chr(92),'label{sec:n}',chr(10),chr(92),'subsection*{Far} word ',chr(92),'label{sec:no}',chr(10),
 chr(92),'end{document}',chr(10)) as tex from documents"""

#: Projects of 200 files, one for each document: most name the next one, some others across the project, graphics without extension and bibliographies.
PROJECT_FILES = """select cast(floor(doc_id / 200.0) as bigint) as doc_id, concat('f', cast(doc_id % 200 as varchar(9)), '.tex') as path, concat(text, chr(10),
 case when doc_id % 11 <> 4 then concat(chr(92), 'input{f', cast(doc_id % 200 + 1 as varchar(9)), '}', chr(10)) else '' end,
 case when doc_id % 7 = 3 then concat(chr(92), 'include{./f', cast(doc_id * 5 % 200 as varchar(9)), '.tex}', chr(10)) else '' end,
 case when doc_id % 3 = 0 then concat(chr(92), 'includegraphics[width=1cm]{g', cast(doc_id % 9 as varchar(9)), '}', chr(10)) else '' end,
 case when doc_id % 13 = 0 then concat(chr(92), 'bibliography{missing,b', cast(doc_id % 5 as varchar(9)), '}', chr(10)) else '' end) as tex from documents
union all select cast(floor(doc_id / 200.0) as bigint), concat('g', cast(doc_id % 200 as varchar(9)), case when doc_id % 2 = 0 then '.png' else '.pdf' end), '' from documents where doc_id % 200 < 9
union all select cast(floor(doc_id / 200.0) as bigint), concat('g', cast(doc_id % 200 as varchar(9)), '.eps'), '' from documents where doc_id % 200 < 9
union all select cast(floor(doc_id / 200.0) as bigint), concat('b', cast(doc_id % 200 - 20 as varchar(9)), '.bib'), '' from documents where doc_id % 200 between 20 and 24"""

_CATEGORY = "case (doc_id*7+{pos}*5) % 11 when 0 then 'PaperTitle' when 1 then 'Abstract' when 2 then 'Title' when 3 then 'Equation' when 4 then 'List' when 5 then 'Footnote' when 6 then 'Text-EQ' when 7 then 'Table' when 8 then 'Caption' else 'Text' end"
_LINES = {
    "spark": "select doc_id, pos, line from documents lateral view posexplode(split(text, chr(10))) t as pos, line",
    "duckdb": "select doc_id, unnest(range(len(l))) as pos, unnest(l) as line from (select doc_id, string_split(text, chr(10)) l from documents)",
}


def blocks_sql(dialect: str) -> str:
    """Layout blocks: a line each, with integral boxes so that sums are exact."""
    return f"""select doc_id, cast(doc_id*100000+pos as bigint) block_id, cast(pos as bigint) ann_pos,
 case when cont then prev_cat else cat end as category, cast((pos - pos % 10)/10 as bigint) page_index,
 cast(100*(pos % 2) + doc_id % 13 as double) x0, cast(30*(pos % 10) as double) y0,
 cast(100*(pos % 2) + doc_id % 13 + 20 + length(line) % 140 as double) x1, cast(30*(pos % 10) + 20 + pos % 25 as double) y1,
 case when cont then cast(doc_id*100000+pos-1 as bigint) end as parent_block, line as source_code
 from (select doc_id, pos, line, {_CATEGORY.format(pos="pos")} cat, {_CATEGORY.format(pos="(pos-1)")} prev_cat,
   (pos > 0 and (doc_id+pos) % 6 = 0 and (doc_id*7+(pos-1)*5) % 11 <> 5) cont from ({_LINES[dialect]}) lines_raw) q"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _over(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("from documents", "from {documents}"), documents=documents(spark, sf_dir))


def tex_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tex."""
    return _over(spark, sf_dir, TEX_DOCS.replace("{", "{{").replace("}", "}}"))


def more_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, tex."""
    return _over(spark, sf_dir, MORE_DOCS.replace("{", "{{").replace("}", "}}"))


def project_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id (the project), path, tex."""
    return _over(spark, sf_dir, PROJECT_FILES.replace("{", "{{").replace("}", "}}"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of schema.BLOCKS."""
    return _over(spark, sf_dir, blocks_sql("spark"))


#: Characters with a meaning in LaTeX; in prose that must parse a backslash stands before each.
SPECIAL = r"([$%&#{}_^~|\\])"

#: TeX logs with the layout lengths; one of them is reported twice.
LOGS = "select doc_id, concat('x', chr(10), '[layout: The columnwidth is: 1.0pt]', chr(10), " + ", ".join(
    f"'[layout: The {k} is: ', cast({v} as varchar(19)), '.5pt]', chr(10)" for k, v in {
        "columnwidth": "200 + doc_id % 3 * 100", "columnsep": "10", "textwidth": "410 + doc_id % 4 * 10", "paperwidth": "614", "hoffset": "0", "voffset": "0", "oddsidemargin": "doc_id % 9", "evensidemargin": "3",
        "marginparwidth": "65", "marginparsep": "11", "topmargin": "doc_id % 7", "headheight": "12", "headsep": "25", "footskip": "30", "textheight": "650",
    }.items()
) + ") as log from documents"


#: Changed regions of a mention's pages: three boxes for each line, the last of some on the next page.
_REGIONS = """select doc_id, category, cast(ann_pos as bigint) as idx, cast(page_index + case when k = 2 and ann_pos % 5 = 0 then 1 else 0 end as bigint) as page_index,
 cast(40 + (k * 97 + ann_pos * 13) % 230 as double) as x0, cast(30 * (ann_pos % 10) + 12 * k as double) as y0, cast(40 + (k * 97 + ann_pos * 13) % 230 + 30 + ann_pos % 50 as double) as x1, cast(30 * (ann_pos % 10) + 12 * k + 25 as double) as y1
 from ({blocks}) b cross join (values (0), (1), (2)) as t(k) where category not in ('Figure', 'Footnote')"""


def regions_sql(dialect: str) -> str:
    return _REGIONS.replace("{blocks}", blocks_sql(dialect))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, category, idx, page_index and a box of each changed region."""
    return _over(spark, sf_dir, regions_sql("spark"))
