"""Operators whose work must follow their output, on inputs where all pairs would not end."""

import random
import time

import numpy as np
import pytest

from texloom.operators import clean, closure, parse, quality, tree

BOXES = "doc_id bigint, page_index bigint, block_id bigint, x0 double, y0 double, x1 double, y1 double"


def meeting(rows):
    out = []
    for k, (d, p, i, x0, y0, x1, y1) in enumerate(rows):
        for e, q, j, u0, v0, u1, v1 in rows:
            if (d, p) == (e, q) and i < j and x0 <= u1 and u0 <= x1 and y0 <= v1 and v0 <= y1:
                out.append((d, p, i, j, (min(x1, u1) - max(x0, u0)) * (min(y1, v1) - max(y0, v0))))
    return sorted(out)


@pytest.mark.parametrize("shape", ["small", "lines", "points", "mixed", "inverted", "equal"])
def test_overlaps_equal_all_pairs(spark, shape):
    rng = random.Random(shape)
    rows = []
    for i in range(300):
        x, y = rng.randint(0, 400), rng.randint(0, 600)
        w, h = {"small": (9, 9), "lines": (500, 2), "points": (0, 0), "mixed": rng.choice([(2, 2), (300, 400), (1, 500)]), "inverted": (rng.randint(-30, 60), rng.randint(-30, 60)), "equal": (40, 40)}[shape]
        if shape == "equal":
            x, y = 7, 7
        rows.append((i % 2, i % 3, i, float(x), float(y), float(x + w), float(y + h)))
    rows.append((9, 0, 999, 1.0, 1.0, 2.0, 2.0))
    found = quality.overlaps(spark.createDataFrame(rows + [(1, 1, 1000, None, 1.0, 2.0, 2.0)], BOXES))
    assert sorted(tuple(r) for r in found.collect()) == meeting(rows)


def test_twenty_thousand_boxes_of_one_page(spark):
    n = 20_000
    boxes = spark.range(n).selectExpr("0L as doc_id", "0L as page_index", "id as block_id", "double(id % 140 * 10) as x0", "double(id div 140 * 10) as y0", "double(id % 140 * 10 + 9) as x1", "double(id div 140 * 10 + 9) as y1")
    began = time.time()
    assert quality.overlaps(boxes).count() == 0 and time.time() - began < 30


NODES = "doc_id bigint, pre int, post int, parent_pre int, depth int, name string"


def nested(rng, n):
    """Rows of a random tree in pre-order."""
    parents = [None] + [rng.randint(max(0, k - 4), k - 1) if rng.random() < 0.95 else None for k in range(1, n)]
    # a parent must lie on the path to the node before: climb from it
    path, fixed = [], []
    for k in range(n):
        while path and (parents[k] is None or path[-1] > parents[k]):
            path.pop()
        fixed.append(path[-1] if path else None)
        path.append(k)
    children = {}
    for k, p in enumerate(fixed):
        children.setdefault(p, []).append(k)
    post, depth, clock = [0] * n, [0] * n, 0
    stack = [(k, 0) for k in reversed(children.get(None, []))]
    while stack:
        k, d = stack.pop()
        if d < 0:
            post[k] = clock
            clock += 1
            continue
        depth[k] = d
        stack.append((k, -1))
        stack += [(c, d + 1) for c in reversed(children.get(k, []))]
    return [(k, post[k], fixed[k], depth[k]) for k in range(n)]


def test_descendants_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = [(d, *r, rng.choice("abc")) for d in range(5) for r in nested(rng, 150)]
    nodes = spark.createDataFrame(rows, NODES)
    found = tree.descendants(nodes.where("name <> 'c'"), nodes.where("name <> 'b'"))
    assert found.columns == ["of_pre", "doc_id", "pre", "post", "parent_pre", "depth", "name"]
    want = sorted((a[1], *b) for a in rows for b in rows if a[0] == b[0] and a[5] != "b" and b[5] != "c" and b[1] > a[1] and b[2] < a[2])
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(want, key=str)
    inner = tree.enclosing(nodes, nodes.where("name = 'a'"))
    by = {}
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[5] == "a" and b[1] > a[1] and b[2] < a[2]:
                by[b[0], b[1]] = max(a[1], by.get((b[0], b[1]), -1))
    assert {(r["doc_id"], r["pre"]): r["of_pre"] for r in inner.collect()} == by


def test_a_hundred_thousand_nodes_in_one_document(spark):
    """Fifty thousand pairs of a parent and its one leaf: all pairs would be 5e9."""
    half = 50_000
    parents = spark.range(half).selectExpr("1L as doc_id", "int(2 * id) as pre", "int(2 * id + 1) as post", "cast(null as int) as parent_pre", "0 as depth", "'p' as name")
    leaves = spark.range(half).selectExpr("1L as doc_id", "int(2 * id + 1) as pre", "int(2 * id) as post", "int(2 * id) as parent_pre", "1 as depth", "'l' as name")
    began = time.time()
    found = tree.descendants(parents.union(leaves), parents)
    assert found.count() == half and found.where("pre <> of_pre + 1").isEmpty() and time.time() - began < 30


def test_a_deep_document(spark):
    """Descendants of groups that the parser nests."""
    docs = spark.createDataFrame([(1, "{a" * 60 + "\\label{x}" + "}" * 60)], "doc_id bigint, tex string")
    nodes = parse.parse_nodes(docs)
    assert tree.descendants(nodes.where("name = 'label'"), nodes.where("kind = 'group' and slot = 'content'")).count() == 60


def closed(edges, roots):
    found, todo = set(roots), list(roots)
    while todo:
        d, p = todo.pop()
        for e, a, b in edges:
            if (e, a) == (d, p) and (d, b) not in found:
                found.add((d, b))
                todo.append((d, b))
    return sorted(found)


def test_reachable_equals_a_walk(spark):
    rng = random.Random(8)
    edges = sorted({(d, f"f{rng.randint(0, 40)}", f"f{rng.randint(0, 40)}") for d in range(4) for _ in range(45)})
    roots = [(d, f"f{k}") for d in range(4) for k in range(2)] + [(77, "alone")]
    found = closure.reachable(spark.createDataFrame(edges, "doc_id bigint, path string, target string"), spark.createDataFrame(roots, "doc_id bigint, path string"))
    assert sorted(tuple(r) for r in found.collect()) == closed(edges, roots)


def test_a_chain_of_two_hundred_files(spark):
    files = spark.range(200).selectExpr("1L as doc_id", "concat('f', id, '.tex') as path", r"concat('\\input{f', id + 1, '}') as tex")
    found = closure.dependencies(files, spark.createDataFrame([(1, "f0.tex")], "doc_id bigint, path string"))
    assert found.count() == 200
    plan = found._jdf.queryExecution().toString()
    assert plan.count("Join") < 40


def test_named_files(spark):
    tex = r"""\documentclass[a4paper]{art} \usepackage{one, two}% \usepackage{hidden}
\input{./sec/a} \include{b.tex} \subimport{sub/}{c} \import{ d }{e.tex} \includegraphics[width=1cm]{fig} \bibliography{x,y} \bibliographystyle{plain} \lstinputlisting[a=b]{code.c} \input{} \% \input{ z }"""
    there = ["art.cls", "one.sty", "hidden.sty", "sec/a.tex", "b.tex", "sub/c.tex", "d/e.tex", "fig.png", "fig.pdf", "y.bib", "plain.bst", "code.c", "z.tex", "unused.tex"]
    files = spark.createDataFrame([(1, "main.tex", tex)] + [(1, p, "") for p in there] + [(2, "two.sty", "")], "doc_id bigint, path string, tex string")
    found = {(r["kind"], r["target"]) for r in closure.dependency_edges(files).collect()}
    assert found == {("class", "art.cls"), ("style", "one.sty"), ("include", "sec/a.tex"), ("include", "b.tex"), ("import", "sub/c.tex"), ("import", "d/e.tex"), ("graphics", "fig.pdf"), ("bibliography", "y.bib"), ("bibliography style", "plain.bst"), ("listing", "code.c"), ("include", "z.tex")}
    assert closure.dependencies(files, spark.createDataFrame([(1, "main.tex")], "doc_id bigint, path string")).count() == 12


def test_annotated_reads_blocks_once(spark):
    from texloom.operators import clean

    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    docs = spark.createDataFrame([(1, r"\begin{document}\section{A}\label{a} x \ref{a}\end{document}")], "doc_id bigint, tex string")
    blocks = spark.createDataFrame([(1, k, k, c, s) for k, (c, s) in enumerate([("Title", r"\section{A}"), ("Text", r"x \ref{a}")])], "doc_id bigint, block_id bigint, ann_pos bigint, category string, source_code string")
    blocks = blocks.selectExpr("*", "0L as page_index", "0d as x0", "0d as y0", "0d as x1", "0d as y1", "cast(null as bigint) as parent_block")
    found = clean.annotated(docs, blocks.mapInPandas(counted, blocks.schema))["orders"]
    assert {(r["type"], r["from_id"], r["to_id"]) for r in found.collect()} == {("sub", 1, 0), ("explicit-cite", 1, 0)} and seen.value == 2


def test_texts_of_files_that_nobody_needs_are_not_shuffled(spark):
    """They lie uneven: the first of many partitions hold them, and a join that reads its shuffle by mapper would give all of them to one task."""
    texts = spark.range(40).selectExpr("id % 2 as doc_id", "concat('spare', id, '.tex') as path", "array_join(transform(sequence(1, 3000), k -> sha2(cast(k * 41 + id as string), 256)), '') as tex").repartition(4).persist()
    texts.count()
    few = spark.createDataFrame([(0, "main.tex", "a\\input{b}% gone"), (0, "b.tex", "B"), (1, "main.tex", "no includes")], "doc_id long, path string, tex string")
    found = texts.union(few)
    made = clean.clean_project(found, found.where("path = 'main.tex'").select("doc_id", "path"))
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = shuffled()
    assert sorted(tuple(r) for r in made.collect()) == [(0, "b.tex", "B"), (0, "main.tex", "aB"), (1, "main.tex", "no includes")]
    assert shuffled() - before < 1 << 20
    texts.unpersist()
