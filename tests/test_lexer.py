"""Native tokens, brackets and environments against the parser's."""

import random

import pytest

from texloom import fixtures
from texloom.operators import lexer, parse
from texloom.plans.queries import _safe

D = "/root/testdata/sf0.001"
PIECES = ["\\", "{", "}", "[", "]", "$", "$$", "%", "\n", " ", "\t", "a", "é", "𝄞", "\x00", "\x7f", "\\(", "\\)", "\\[", "\\]", "\\left(", "\\big\\{", "\\Big|", "\\item", "\\a*", "\\left\\langle", "\\\\", "\\%", "12"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(21)
    odd = [(i, "".join(rng.choices(PIECES, k=rng.randint(0, 40)))) for i in range(1500)]
    return spark.createDataFrame(odd + [(5000, None), (5001, "")], "doc_id bigint, tex string").union(fixtures.tex_docs(spark, D).selectExpr("doc_id + 10000", "tex")).union(fixtures.more_docs(spark, D).selectExpr("doc_id + 20000", "tex")).cache()


def test_tokens_equal_the_parsers(spark, docs):
    columns = ["doc_id", "tok_pos", "char_pos", "category", "text"]
    a, b = lexer.lex(docs).select(columns), parse.lex(docs).select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 50_000
    assert "Python" not in lexer.lex(docs)._jdf.queryExecution().toString() and "MapInArrow" not in lexer.lex(docs)._jdf.queryExecution().toString()


def test_brackets_equal_a_stack(docs):
    got = {}
    for r in lexer.brackets(lexer.lex(docs)).collect():
        got.setdefault((r["doc_id"], r["kind"]), set()).add((r["char_pos"], r["char_end"]))
    for doc_id, tex in docs.collect():
        open_, groups, closed = [], set(), set()
        for start, kind, _ in parse.tokens(tex or ""):
            if kind in ("GroupBegin", "BracketBegin"):
                open_.append((kind, start))
            elif kind == "BracketEnd" and open_ and open_[-1][0] == "BracketBegin":
                closed.add((open_.pop()[1], start + 1))
            elif kind == "GroupEnd":
                while open_:
                    was, at = open_.pop()
                    if was == "GroupBegin":
                        groups.add((at, start + 1))
                        break
        assert got.get((doc_id, "group"), set()) == groups, tex
        assert got.get((doc_id, "bracket"), set()) == closed, tex
        assert {a for a, _ in closed} == parse.Parser(tex or "").closed


def test_environments_equal_the_parsers(spark):
    docs = _safe(spark, D).union(spark.createDataFrame([(9001, "\\begin{a}\\begin {b}x\\end{b}\\begin{verbatim}\\begin{c}%\\end{verbatim}\\end\n{a} \\% \\begin{d}\\end{d} % \\end{x}"), (9002, "")], "doc_id bigint, tex string"))
    nodes = parse.parse_nodes(docs)
    want = nodes.where("kind = 'env'").selectExpr("doc_id", "name", "char_pos", "char_end")
    found = lexer.environments(docs)
    assert found.where("error is not null").isEmpty() and nodes.where("error is not null").isEmpty()
    found = found.select("doc_id", "name", "char_pos", "char_end")
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty() and found.count() > 500


def test_environments_that_do_not_close(spark):
    docs = spark.createDataFrame([(1, "\\begin{a}\\begin{b}\\end{a}"), (2, "\\end{a}\\begin{a}x\\end{a}"), (3, "\\begin{a}\\end{b}")], "doc_id bigint, tex string")
    found = {(r["doc_id"], r["name"], r["char_end"] is None, r["error"]) for r in lexer.environments(docs).collect()}
    assert found == {(1, "a", True, "not closed"), (1, "b", True, "closed by a"), (2, "a", True, "ends nothing"), (2, "a", False, None), (3, "a", True, "closed by b")}
