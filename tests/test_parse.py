import random

import pytest

from texloom.operators import parse


def show(n):
    return n.begin if n.kind == "text" else (n.kind, n.name, [show(a) for a in n.args], [show(b) for b in n.body])


def body(text, **kw):
    return [show(n) for n in parse.parse(text, **kw).body]


@pytest.mark.parametrize(("text", "want"), [
    (r"\item aaa {bbb} ccc", [("item", "item", [], [" aaa ", ("group", "", [], ["bbb"]), " ccc"])]),
    (r"\item WITCH [nuuu] DOC", [("item", "item", [], [" WITCH ", "[", "nuuu", "]", " DOC"])]),
    (r"\foo[walla]{walla}{ba]ng}", [("cmd", "foo", [("bracket", "", [], ["walla"]), ("group", "", [], ["walla"]), ("group", "", [], ["ba", "]", "ng"])], [])]),
    ("\\sect  \t   \n\t \n{bingbang}", [("cmd", "sect", [], []), "  \t   \n\t ", "\n", ("group", "", [], ["bingbang"])]),
    (r"\infty{x}", [("cmd", "infty", [], []), ("group", "", [], ["x"])]),
    (r"\begin{verbatim}\textbf{aa \end{verbatim}ha", [("env", "verbatim", [], [r"\textbf{aa "]), "ha"]),
    ("\\begin{foobar} t \\end\n{foobar}w", [("env", "foobar", [], [" t "]), "w"]),
    (r"$x$\[y\]", [("math", "$", [], ["x"]), ("math", "displaymath", [], ["y"])]),
    (r"{\incomplete! [complete}", [("group", "", [], [("cmd", "incomplete", [], []), "! ", "[", "complete"])]),
])
def test_trees(text, want):
    assert body(text) == want


@pytest.mark.parametrize("text", [r"\begin{a}x", "$x", "{x", r"\begin x", r"$\item$"])
def test_errors_say_where(text):
    with pytest.raises(parse.ParseError, match=r"\[Line: 0, Offset: \d+\]"):
        parse.parse(text)


def test_tolerant():
    assert body(r"\begin{a}x\end{b}y", tolerant=True)[0] == ("env", "a", [], ["x"])


def test_round_trips_and_nesting():
    rnd, bits = random.Random(3), ["a", " ", "\n", "\n\n", r"\textbf{b}", r"\begin{itemize}\item c\end{itemize}", r"\label{l}", r"\[z\]", "$q$ ", r"\section{S}", "{g}", "[h]", "% c\n", r"\begin{theorem}t\end{theorem}", r"\\", r"\foo[", r"\def\x{y}"]
    for _ in range(500):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert "".join(t for _, _, t in parse.tokens(text)) == text
        root = parse.parse(text)
        assert "".join(s[3] for s in parse.segments_of(text, root.body)) == text
        for pre, post, parent, *_ in (rows := parse.rows_of(root, text)):
            assert parent is None or rows[parent][0] < pre and rows[parent][1] > post
    deep = r"\foo[" * 3000
    assert len(body(deep)) >= 3000


def test_failed_rows_keep_the_job(spark):
    df = spark.createDataFrame([(1, "ok $x$"), (2, "bad $"), (3, None), (4, "{" * 50_000)], "doc_id bigint, tex string")
    rows = parse.parse_nodes(df).collect()
    assert {r.doc_id for r in rows if r.error} == {2, 4} and {r.doc_id for r in rows if not r.error} == {1}


def test_groups():
    assert parse.group_of("{a}") == ("group", "a") and parse.group_of("[b]") == ("bracket", "b")
    with pytest.raises(TypeError):
        parse.group_of("(c)")


@pytest.mark.parametrize("text", ["{" * 4000 + "x" + "}" * 4000, "\\a{" * 3000 + "}" * 3000, "\\begin{center}" * 2000 + "x" + "\\end{center}" * 2000, "\\a[" * 1500 + "x" + "]" * 1500])
def test_texts_of_any_depth_parse(text):
    root = parse.parse(text)
    assert max(r[3] for r in parse.rows_of(root, text)) >= 1499
    assert "".join(s[3] for s in parse.segments_of(text, root.body)) == text


def test_texts_hold_no_lists_of_their_own():
    """Most nodes are texts: they share what they have instead of arguments and a body."""
    leaves = [n for n in parse.parse("\\textbf{a} b \\$ c\n[d]").body if n.kind == "text"]
    assert len(leaves) == 6 and all(n.args is leaves[0].body and n.body is leaves[0].body for n in leaves)
