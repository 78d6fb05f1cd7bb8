"""Values of the queries that have no SQL: parsed segments, whole documents in colour, JSON views."""

import json

import pytest
from pyspark.sql import functions as F

from texloom import fixtures
from texloom.functions import tex as T
from texloom.operators import colour, export, extract, order, parse, segments
from texloom.plans import queries

D = "/root/testdata/sf0.001"
TEX = "\\documentclass{a}\n\\title{T}\n\\begin{document}\n\\section{One}\n\nPlain words.\n\nWith $x$ in it.\n\n\\begin{itemize}\\item a\\end{itemize}\n\n\\begin{equation}y\\end{equation}\n\n\\begin{center}\nInside.\n\\end{center}\n\\begin{tabular}{c}1\\end{tabular}\n\\end{document}\n"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, TEX), (2, "no document"), (3, "\\begin{document}\\begin{a}\\end{document}"), (4, None)], "doc_id bigint, tex string")


def test_segments_and_their_mentions(docs):
    main = docs.where("doc_id = 1").select("doc_id", T.main_content("tex")[0].alias("tex"))
    found = parse.parse_segments(main)
    rows = [(r.kind, r.name, r.text) for r in found.orderBy("seg_pos").collect()]
    assert ("command", "section", "\\section{One}") in rows and ("captured", "itemize", "\\begin{itemize}\\item a\\end{itemize}") in rows and ("captured", "equation", "\\begin{equation}y\\end{equation}") in rows
    assert ("begin", "center", "\\begin{center}") in rows and ("end", "center", "\\end{center}") in rows and "".join(t for _, _, t in rows) == main.head().tex
    said = [(r.category, r.idx, r.source_code.strip()) for r in segments.segment_mentions(found).orderBy("category", "idx").collect()]
    assert said == [("Equation", 0, "\\begin{equation}y\\end{equation}"), ("List", 0, "\\begin{itemize}\\item a\\end{itemize}"), ("Text", 0, "Plain words."), ("Text", 1, "Inside."), ("Text-EQ", 0, "With $x$ in it."), ("Title", 0, "\\section{One}")]


def test_rendered_documents(docs):
    got = {r.doc_id: (r.tex, r.error) for r in colour.rendered(docs).collect()}
    assert got[2] == (None, "no main content") and got[4] == (None, "no main content") and got[3][0] is None and "not closed" in got[3][1]
    text = got[1][0]
    for part in ("{\\color{Title_color}\\section{One}}", "{\\textcolor{Text_color}{Plain words.}}", "{\\textcolor{Text-EQ_color}{With $x$ in it.}}", "{\\color{List_color}\\begin{itemize}", "{\\color{Equation_color}{\\begin{equation}y\\end{equation}}}", "{\\color{Table_color}\\begin{tabular}{c}1\\end{tabular}}", "\\title{{\\textcolor{PaperTitle_color}{T}}}"):
        assert part in text, part
    plain = text
    for name in ("Title", "Text", "Text-EQ", "List", "Equation", "Table", "PaperTitle"):
        plain = plain.replace(f"\\color{{{name}_color}}", "").replace(f"\\textcolor{{{name}_color}}", "")
    assert plain.replace("{", "").replace("}", "") == TEX.replace("{", "").replace("}", "")
    counts = {r.category: r["count"] for r in colour.mention_order(docs.where("doc_id = 1").select("doc_id", F.lit(text).alias("tex"))).groupBy("category").count().collect()}
    assert counts == {"Title": 1, "Text": 2, "Text-EQ": 1, "List": 1, "Equation": 1, "Table": 1, "PaperTitle": 1}


def test_rendered_queries_agree(spark):
    """The query's counts are those of the mentions that segments and patterns find in the same documents."""
    docs = queries._safe(spark, D)
    rendered = {(r.doc_id, r.category): r.n for r in queries.QUERIES["q48_rendered_mentions"](spark, D).collect()}
    main = parse.parse_segments(docs.select("doc_id", T.main_content("tex")[0].alias("tex")))
    want = {(r.doc_id, r.category): r["count"] for r in segments.segment_mentions(main).where("category in ('Title', 'List', 'Equation')").groupBy("doc_id", "category").count().collect()}
    assert {k: n for k, n in rendered.items() if k[1] in ("Title", "List", "Equation")} == want and len(want) > 100


def test_parse_errors_say_where(spark):
    df = spark.createDataFrame([(1, "a\n{b"), (2, "\\begin{x}"), (3, "$a"), (4, "fine")], "doc_id bigint, tex string")
    got = {r.doc_id: r.error for r in parse.parse_nodes(df).where("error is not null").collect()}
    assert got == {1: "[Line: 1, Offset: 0] Malformed argument: not closed.", 2: "[Line: 0, Offset: 0] \\begin{x} is not closed.", 3: "[Line: 0, Offset: 0] Expecting $."}


def test_json_views(spark):
    blocks = fixtures.blocks(spark, D).where("doc_id < 20")
    by = {}
    for r in blocks.orderBy("ann_pos").collect():
        by.setdefault(r.doc_id, {}).setdefault(str(r.page_index), []).append({"block_id": r.block_id, "category": r.category, "page_index": r.page_index, "parent_block": -1 if r.parent_block is None else r.parent_block, "source_code": r.source_code, "bbox": [r.x0, r.y0, r.x1, r.y1]})
    assert {r.doc_id: json.loads(r.layout) for r in export.layout_info(blocks).collect()} == by
    orders = order.reading_order(blocks)
    want = {}
    for r in orders.collect():
        want.setdefault(r.doc_id, []).append([r.type, r.from_id, r.to_id])
    got = {r.doc_id: [[x["type"], x["from"], x["to"]] for x in json.loads(r.orders)] for r in export.order_annotations(orders).collect()}
    assert {d: sorted(map(tuple, v)) for d, v in got.items()} == {d: sorted(map(tuple, v)) for d, v in want.items()} and all([x[1] for x in v] == sorted(x[1] for x in v) for v in got.values())
    coco = {r.doc_id: json.loads(r.coco) for r in export.coco_documents(blocks, 612, 792).collect()}
    assert {d: [a["bbox"] for a in v["annotations"]] for d, v in coco.items()} == {d: [[b["bbox"][0], b["bbox"][1], b["bbox"][2] - b["bbox"][0], b["bbox"][3] - b["bbox"][1]] for p in sorted(pages, key=int) for b in pages[p]] for d, pages in by.items()}


def test_mention_maps(spark):
    docs = fixtures.tex_docs(spark, D)
    want = {}
    for r in sorted(extract.mentions(docs).collect(), key=lambda r: (r.doc_id, r.category, r.idx)):
        want.setdefault(r.doc_id, {}).setdefault(r.category, []).append(r.source_code)
    assert {r.doc_id: r.texts for r in extract.mention_map(extract.mentions(docs)).collect()} == want
