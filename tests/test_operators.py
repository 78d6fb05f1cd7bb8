import gzip
import io
import json
import random
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from texloom import fixtures, schema
from texloom.operators import clean, export, extract, includes, layout, order, raster, records, refs
from texloom.sources import files, services
from texloom.streaming import ingest


def stack_model(blocks):
    """Reading order as a stack machine, for documents that begin with no footnote."""
    out, stack = [], []
    for b in blocks:
        kind = "title" if b["category"] in schema.TITLE_LIKE else "fn" if b["category"] == "Footnote" else "text"
        if not stack:
            if kind != "fn":
                stack.append((b["id"], kind))
            continue
        if b["parent"] == stack[-1][0]:
            out.append(("identical", b["id"], stack[-1][0]))
            if kind != "fn":
                stack[-1] = (b["id"], kind)
        elif kind == "text":
            out.append(("adj" if stack[-1][1] == "text" else "sub", b["id"], stack[-1][0]))
            stack = [x for x in stack if x[1] == "title"] + [(b["id"], kind)]
        elif kind == "title":
            while stack and stack[-1][1] == "text":
                stack.pop()
            if stack:
                out.append(("peer", b["id"], stack[-1][0]))
            stack = [(b["id"], kind)]
        else:
            out.append(("explicit-cite", b["id"], stack[-1][0]))
    return out


def test_reading_order_equals_a_stack(spark):
    rnd, rows, want = random.Random(9), [], set()
    for doc in range(60):
        blocks = []
        for k in range(rnd.randint(1, 20)):
            category = rnd.choice([c for c in schema.SORTABLE if k or c != "Footnote"])
            blocks.append({"id": doc * 100 + k, "category": category, "parent": None})
        want |= {(doc, *r) for r in stack_model(blocks)}
        rows += [(doc, b["id"], i, b["category"], b["parent"]) for i, b in enumerate(blocks)]
    df = spark.createDataFrame(rows, "doc_id long, block_id long, ann_pos long, category string, parent_block long")
    assert set(map(tuple, order.reading_order(df).collect())) == want


def test_cross_references_take_the_last_label(spark):
    rows = [(1, 1, 0, "Text", r"\label{a}"), (1, 2, 1, "Equation", r"\label{a}"), (1, 3, 2, "Text", r"\ref{a} \eqref{a} \cref{} \ref{b}"), (1, 4, 3, "Caption", r"\autoref{a}"), (1, 5, 4, "Title", r"\ref{a}")]
    df = spark.createDataFrame(rows, "doc_id long, block_id long, ann_pos long, category string, source_code string")
    assert sorted(map(tuple, refs.cross_references(df).collect())) == [(1, "explicit-cite", 3, 2), (1, "explicit-cite", 3, 2), (1, "implicit-cite", 4, 2)]


def test_title_labels(spark):
    df = spark.createDataFrame([(1, "\\section{A}\\label{x}\\section{B} \n\\label{y}\\subsection*{C \\label{in}} z \\label{w}")], "doc_id long, tex string")
    assert [(r.title[:10], r.label) for r in refs.title_labels(df).orderBy("idx").collect()] == [("\\section{A", "x"), ("\\section{B", "y"), ("\\subsectio", "in")]


def flood_boxes(mask):
    seen, out = np.zeros_like(mask), []
    for y, x in np.argwhere(mask):
        if seen[y, x]:
            continue
        todo, cells = [(y, x)], []
        seen[y, x] = True
        while todo:
            a, b = todo.pop()
            cells.append((a, b))
            for i in range(max(a - 1, 0), min(a + 2, mask.shape[0])):
                for j in range(max(b - 1, 0), min(b + 2, mask.shape[1])):
                    if mask[i, j] and not seen[i, j]:
                        seen[i, j] = True
                        todo.append((i, j))
        ys, xs = zip(*cells, strict=True)
        out.append((min(xs), min(ys), max(xs) + 1, max(ys) + 1))
    return out


def test_component_boxes_equal_flood_fill():
    rng = np.random.default_rng(2)
    for share in (0, 0.1, 0.3, 0.5, 1):
        for _ in range(20):
            mask = rng.random((rng.integers(1, 25), rng.integers(1, 25))) < share
            assert sorted(map(tuple, raster.component_boxes(mask).tolist())) == sorted(flood_boxes(mask))


def test_merged_fragments_grow(spark):
    rows = [(1, "Text", 0, 0, 0, i, x, 0.0, x + 12.0, 10.0) for i, x in enumerate((0.0, 10.0, 20.0, 50.0))] + [(1, "Text", 0, 1, 0, 4, 50.0, 0.0, 62.0, 10.0)]
    df = spark.createDataFrame(rows, "doc_id long, category string, idx long, page_index long, col long, ann_pos long, x0 double, y0 double, x1 double, y1 double")
    assert [(r.page_index, r.x0, r.x1, r.parent_fragment) for r in layout.merged_fragments(df).orderBy("fragment").collect()] == [(0, 0.0, 32.0, None), (0, 50.0, 62.0, 0), (1, 50.0, 62.0, 1)]


def test_export_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([("cs", "p1", 1), ("cs", "p2", 2)], "discipline string, paper_id string, v int")
    for rows in (df.where("v = 1"), df, df):
        export.export(rows, str(tmp_path / "out"), ["discipline", "paper_id"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_coco_document(spark):
    blocks = fixtures.blocks(spark, "/root/testdata/sf0.001").where("doc_id = 1")
    doc = json.loads(export.coco_documents(blocks, 612, 792).head().coco)
    assert len(doc["categories"]) == 15 and len(doc["annotations"]) == blocks.count() and doc["annotations"][0]["id"] == 0


def test_upsert_and_graphics(spark):
    known = spark.createDataFrame([("a", 1)], "paper_id string, v int")
    assert sorted(map(tuple, records.upserted(known, spark.createDataFrame([("a", 2), ("b", 3)], "paper_id string, v int")).collect())) == [("a", 1), ("b", 3)]
    used = spark.createDataFrame([(1, "x"), (1, "y.pdf"), (1, "z.png"), (1, "gone")], "doc_id int, old string")
    found = records.resolved_graphics(used, spark.createDataFrame([(1, "x.jpg"), (1, "x.png"), (1, "y.pdf"), (1, "z.png")], "doc_id int, path string"))
    assert {r.old: r.new for r in found.collect()} == {"x": "x.jpg", "y.pdf": "y.png", "z.png": "z.png"}


def test_file_sources(spark, tmp_path):
    base = tmp_path / "cs" / "p1"
    base.mkdir(parents=True)
    (base / "main.tex").write_text("\\begin{document}é\\end{document}")
    (base / "notes.txt").write_text("x")
    (tmp_path / "top.tex").write_text("no")
    (tmp_path / "m.csv").write_text("path,status\na,success\nb,failed\n")
    assert files.texts(spark, str(tmp_path)).count() == 2
    found = files.files(spark, str(tmp_path), ".tex").withColumn("path", F.regexp_replace("path", "^file:", ""))
    depth = len(str(tmp_path).split("/"))
    assert [(r.discipline, r.paper_id) for r in records.main_documents(found, depth).collect()] == [("cs", "p1")]
    assert [r.path for r in records.successful(files.manifest(spark, str(tmp_path / "m.csv"))).collect()] == ["a"]
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        tar.add(base / "main.tex", "main.tex")
    rows = spark.createDataFrame([("good.tar.gz", buffer.getvalue()), ("bad.tar.gz", gzip.compress(b"x")[:9])], "path string, content binary")
    members = {r.path: (r.member, r.error is None) for r in files.archive_members(rows).collect()}
    assert members == {"good.tar.gz": ("main.tex", True), "bad.tar.gz": (None, False)}


def test_services_say_what_is_missing(spark):
    with pytest.raises(RuntimeError, match="not installed"):
        services.run_tool("no-such-tool", "main.tex", "/tmp")
    assert services.tool_command("bibtex", "main.tex") == ["bibtex", "main"]
    spark.dataSource.register(services.PaperSearch)
    assert spark.read.format("paper_search").load().count() == 0


def test_streaming_ingest_adds_once(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.tex").write_text("\\title{A}\n% \\title{no}\n\\caption{c}")
    for step in range(2):
        ingest.ingest(spark, str(source), target, str(tmp_path / f"check{step}")).awaitTermination(120)
    assert sorted(r.source_code for r in spark.read.parquet(target).collect()) == ["\\caption{c}", "\\title{A}"]


def test_unequal_page_pairs_are_errors_of_their_row(spark):
    white, dot = bytes([255] * 12), bytes([255] * 3 + [0] * 3 + [255] * 6)
    rows = [(1, 0, 2, 2, 3, dot, white), (2, 0, 2, 2, 3, dot[:9], white), (3, 0, 2, 2, 3, None, white), (4, 0, None, 2, 3, dot, white), (5, 0, 2, 2, 3, white, white), (6, 1, 9, 9, 3, dot, white)]
    df = spark.createDataFrame(rows, "doc_id long, page_index long, height int, width int, channels int, drawn binary, blank binary")
    found = {r.doc_id: r for r in raster.changed_boxes(df).collect()}
    assert (found[1].x0, found[1].y0, found[1].x1, found[1].y1, found[1].error) == (1, 0, 2, 1, None) and sorted(found) == [1, 2, 3, 4, 6]
    assert all(found[k].error and found[k].x0 is None for k in (2, 3, 4, 6))


def test_includes_of_any_depth_and_in_cycles(spark):
    rows = [(1, f"f{k}.tex", f"{k} \\input{{f{k + 1}}}") for k in range(15)] + [(1, "f15.tex", "end")]
    rows += [(2, "a.tex", "A\\input{b}\\input{b}\\input{none}Z"), (2, "b.tex", "B[\\include{a}\\input{c.tex}]"), (2, "c.tex", ""), (3, "a.tex", None), (4, "a.tex", "no includes")]
    files = spark.createDataFrame(rows, "doc_id long, path string, tex string")
    roots = spark.createDataFrame([(1, "f0.tex"), (2, "a.tex"), (2, "b.tex"), (3, "a.tex"), (4, "a.tex"), (5, "gone.tex")], "doc_id long, path string")
    got = {(r.doc_id, r.path): r.tex for r in includes.resolved(files, roots).collect()}
    assert got[1, "f0.tex"] == " ".join(map(str, range(15))) + " end" and got[4, "a.tex"] == "no includes"
    assert got[2, "a.tex"] == "AB[\\include{a}]B[\\include{a}]\\input{none}Z" and got[2, "b.tex"] == "B[A\\input{b}\\input{b}\\input{none}Z]"
    assert (5, "gone.tex") not in got


def test_large_projects_are_resolved_in_rounds_and_others_where_they_meet(spark, monkeypatch):
    rng = random.Random(7)
    rows = []
    for d in range(12):
        for k in range(rng.randint(1, 6)):
            commands = [rng.choice(["\\input{%s}", "\\include{%s.tex}", "\\import{sub/}{%s}", "%% \\subimport*{.}{%s}"]) % f"f{rng.randint(0, 6)}" for _ in range(rng.randint(0, 3))]
            rows.append((d, rng.choice([f"f{k}.tex", f"f{k}.tex", f"sub/f{k}.tex"]), rng.choice([None, "", *["é\n".join(["", *commands, f"{d}.{k}"])] * 6])))
    rows += [(3, "f0.tex", "z\\input{f1}"), (3, "f0.tex", "y\\input{f1}"), (None, "f0.tex", "no project"), (4, None, "no path")]
    files = spark.createDataFrame(rows, "doc_id int, path string, tex string").repartition(5)
    roots = files.select("doc_id", "path").union(files.select("doc_id", "path").limit(9))
    jobs = []
    rounds = includes._in_rounds
    monkeypatch.setattr(includes, "_in_rounds", lambda *a: jobs.append("rounds") or rounds(*a))
    got = []
    for most in (1 << 20, 200, -1):
        monkeypatch.setattr(includes, "LARGE", most)
        got.append(sorted(tuple(r) for r in includes.resolved(files, roots).select("doc_id", "path", "tex").collect()))
        assert len(jobs) == len(got) - 1
    assert got[0] == got[1] == got[2] and len(got[0]) > 20 and (3, "f0.tex") in {r[:2] for r in got[0]} and not any(r[2].startswith("z") for r in got[0])


def test_errors_are_rows_and_counted(spark):
    docs = spark.createDataFrame([(1, "\\caption{fine}"), (2, "a \\caption{never closed"), (3, "\\footnote{x \\title{y"), (4, None), (5, "\\begin{abstract}\\end{abstract}\\begin{abstract}\\end{abstract}")], "doc_id bigint, tex string")
    checked, seen = extract.with_errors(docs)
    assert {r.doc_id: r.errors for r in checked.collect()} == {1: [], 2: ["Caption at 2: not closed"], 3: ["PaperTitle at 12: not closed", "Footnote at 0: not closed"], 4: [], 5: ["Abstract: several"]}
    assert seen.get == {"documents": 5, "failed": 3}
    assert {r.doc_id: (r.status, r.error) for r in extract.document_statuses(docs).collect()} == {1: ("success", None), 2: ("failed", "Caption at 2: not closed"), 3: ("failed", "Footnote at 0: not closed"), 4: ("success", None), 5: ("failed", "Abstract: several")}


def test_a_discipline_from_files_to_tables(spark, tmp_path):
    text = "\\begin{document}\\caption{%s}\\end{document}"
    rows = [("/d/cs/p1/main.tex", text % "one"), ("/d/cs/p2/main.tex", "\\begin{document}\\caption{open"), ("/d/cs/p1/notes.txt", "x"), ("/d/math/p3/main.tex", text % "three")]
    made = spark.createDataFrame([(p, t.encode()) for p, t in rows], "path string, content binary")
    target = str(tmp_path / "out")
    said = {r.path: (r.status, r.error) for r in clean.process_discipline(made, 2, target, "cs").collect()}
    assert said == {"/d/cs/p1/main.tex": ("success", None), "/d/cs/p2/main.tex": ("failed", "Caption at 16: not closed")}
    assert clean.process_discipline(made, 2, target, "cs").count() == 0
    assert [r.path for r in clean.process_discipline(made, 2, target).collect()] == ["/d/math/p3/main.tex"]
    found = spark.read.parquet(f"{target}/mentions")
    assert sorted(r.source_code for r in found.collect()) == ["\\caption{one}", "\\caption{three}"] and spark.read.parquet(f"{target}/statuses").count() == 3


def test_dictionaries_are_tables(spark):
    docs = spark.createDataFrame([(1, "\\begin{falign*}a\\end{falign*} \\begin{lemma}x\\begin{proof}y\\end{proof}\\end{lemma}\\begin{proof}z\\end{proof}\\begin{open}")], "doc_id bigint, tex string")
    dictionary = spark.createDataFrame([("lemma", "Theorem", 2), ("proof", "Theorem", 3), ("proof", "Proof", 1), ("falign*", "Equation", 9), (None, "x", 0)], "name string, category string, ord int")
    assert sorted((r.category, r.idx, r.source_code) for r in extract.by_dictionary(docs, dictionary).collect()) == [("Equation", 0, "\\begin{falign*}a\\end{falign*}"), ("Proof", 0, "\\begin{proof}z\\end{proof}"), ("Theorem", 0, "\\begin{lemma}x\\begin{proof}y\\end{proof}\\end{lemma}")]
    assert "falign*" in schema.MATH_ENVS and "flalign*" in schema.MATH_ENVS


def test_equal_captions_stand_in_their_own_floats(spark):
    tex = "\\begin{figure}\\caption{same}\\end{figure} t \\begin{table}\\caption{same}\\begin{tabular}{c}1\\end{tabular}\\end{table} " + "{" * 9 + "}" * 9
    docs = spark.createDataFrame([(1, tex)], "doc_id bigint, tex string")
    found = extract.placed(docs, ["Caption", "Table"])
    assert all(tex[r.m_start : r.m_end] == r.source_code for r in found.collect()) and found.count() == 3
    held = {(r.m_category, r.idx): r.category for r in refs.contained(found, refs.float_spans(docs)).collect()}
    assert held == {("Caption", 0): "Figure", ("Caption", 1): "Table", ("Table", 0): "Table"}
    again = refs.located(found.drop("m_start", "m_end"), docs)
    assert sorted(map(tuple, again.select(*found.columns).collect())) == sorted(map(tuple, found.collect()))
    assert refs.located(spark.createDataFrame([(1, "Caption", 0, "nowhere"), (1, "Caption", 1, "")], "doc_id bigint, category string, idx bigint, source_code string"), docs).isEmpty()


def test_places_equal_the_models(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["\\caption{a}", "\\caption{b{c}}", "{{{{{{{{d}}}}}}}}", "\\footnote{f}", "\\footnotetext[1]{g}", "x", "é\n", "\\begin{tabular}1\\end{tabular}", "\\begin{tabular}\\includegraphics{i}\\end{tabular}"]) for _ in range(rng.randint(0, 15))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, tex string")
    found = extract.placed(docs, ["Caption", "Footnote", "Table"])
    assert all(texts[r.doc_id][r.m_start : r.m_end] == r.source_code for r in found.collect())
    want = extract.mentions(docs).where("category in ('Caption', 'Footnote', 'Table')")
    got = found.select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 100


def test_a_folder_is_cleaned_from_the_command_line(spark, tmp_path, capsys):
    from texloom.__main__ import main

    source, target = tmp_path / "in", tmp_path / "out"
    (source / "sec").mkdir(parents=True)
    (source / "main.tex").write_text("\\documentclass{own}% note\n\n\n\n\\begin{document}\n\\input{sec/a}\n\\includegraphics{fig}\n\\end{document}")
    (source / "sec/a.tex").write_text("A % gone")
    (source / "own.cls").write_text("\n\nclass\n\n\n\nend % kept")
    (source / "main.bbl").write_bytes(b"bbl \xff")
    (source / "fig.png").write_bytes(b"\x89PNG\x00")
    (source / "spare.png").write_bytes(b"x")
    (source / "old.tex").write_text("no document")
    assert main(["clean", str(source), str(target)]) == 0 and "5 files" in capsys.readouterr().out
    assert (target / "main.tex").read_text() == "\\documentclass{own}\n\n\\begin{document}\nA \n\\includegraphics{fig}\n\\end{document}"
    assert (target / "own.cls").read_text() == "class\n\nend % kept" and (target / "fig.png").read_bytes() == b"\x89PNG\x00" and (target / "main.bbl").read_bytes() == b"bbl \xff"
    assert not (target / "spare.png").exists() and not (target / "old.tex").exists()
    paper = tmp_path / "all/cs/p1"
    paper.mkdir(parents=True)
    (paper / "main.tex").write_text("\\begin{document}\\caption{c}\\end{document}")
    assert main(["annotate", str(tmp_path / "all"), str(tmp_path / "tables"), "--discipline", "cs"]) == 0 and "1 success" in capsys.readouterr().out
