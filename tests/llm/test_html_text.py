import re
from html import unescape

import numpy as np
import pytest

from texloom.llm.html_text import BLOCK, LEAST_SHARE, LINKS, MARKED, MENU, OUTSIDE_SHARE, extract, extract_pages, kept_lines

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar-none">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><!-- x --><div class="ad">Buy</div><div id="cookie-notice"><p>We use <b>cookies</b></p><div>ok</div></div>
%s<footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize(("body", "want"), [
    ("<article><h1>Head &amp; line</h1><p>One  two\n three.<br>four<p>fi<b>v</b>e</p><p>Be.</p></article>", "Head & line One two three. four five Be."),
    ("<main><h1>A</h1><p>x</p><aside>side <p>s</p></aside><p>y</p><form><input><p>f</p></form><div class='comments'><article>c</article><p>d</p></div><p>z</p></main>", "A x y z"),
    ("<div><h2>Title here</h2><p>Long paragraph of the article with many words in it.</p><p>So.</p></div>", "Title here Long paragraph of the article with many words in it. So."),
    ("<article><p>&lt;b&gt; &eacute;&#233;&#xe9; &nbsp; a</p><ul><li>i<li>j</ul><pre>k  l</pre></article>", "<b> ééé a i j k l"),
    ("<article><p>a <a href='x>y'>link</a> b</p><script>if (a<b) {}</script><p data-x=\"</p>\">c</p>", "a link b c"),
    ("<div class='site-header'>Site</div><div id='content'><div class='post-header'><h1>A</h1></div><div><p>x, and what follows from it</p></div><div class='share'>s</div><p>y</p></div><div>other text here, quite long but not the article</div>", "A x, and what follows from it y"),
    ("<p>One paragraph of the story, long enough.</p><p><a href='r'>See the whole report of the committee here</a></p><p>Another paragraph of the story, as long.</p>", "One paragraph of the story, long enough. See the whole report of the committee here Another paragraph of the story, as long."),
    ("<p>One paragraph of the story, long enough.</p><ul><li><a>Home page</a><li><a>About us</a><li><a>More links</a></ul><p>Another paragraph of the story, as long.</p>", "One paragraph of the story, long enough. Another paragraph of the story, as long."),
    ("<article><p>It began.</p><section class='search'><p>How the search went on</p><p>and what they found in the end, nobody knows.</p></section><div class='story-share'>Her share of it.</div><div class='share'><a>Tweet</a> Mail</div><p>So.</p></article>", "It began. How the search went on and what they found in the end, nobody knows. Her share of it. So."),
    ("<p>intro text with some words</p><div class='ad'>Buy</div><p>more text with several words that follow it</p><ul><li><a href='x'>l1</a></li><li><a href='y'>l2</a></li></ul>", "intro text with some words more text with several words that follow it"),
])
def test_pages(body, want):
    assert extract(PAGE % body) == want
    assert extract(want.replace("<", "&lt;")) == want


def test_edges(spark):
    for x in ("", " \n", "<", "<p", "<!--", "<script>x", "<nav><p>x</p></nav>", "</p></div>", "<p>" * 5000):
        assert extract(x) in ("", "<")
    assert extract("<nav>open <article><p>t</p></article>") == "t"
    df = spark.createDataFrame([(1, None, None), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (None, "v", "x " * 300_000)], "page_id bigint, url string, html string").selectExpr("*", "'q' as text")
    assert sorted((str(r.page_id), r.url, r.n_chars) for r in extract_pages(df).collect()) == [("1", None, 0), ("2", "u", 1), ("2", "u", 1), ("None", "v", 599_999)]
    assert extract_pages(df.where("false")).count() == 0


def test_all_article_text_of_the_synthetic_pages(spark):
    for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inner = re.sub(r"</?b>", "", inner)
        assert extract(r.html) == " ".join(unescape(re.sub(r"<[^>]+>", " ", inner)).split())


STORY = [f"Paragraph {i} of the story with quite a number of words in it." for i in range(8)]


def test_a_marked_card_does_not_hide_the_story():
    story = "".join(f"<p>{x}</p>" for x in STORY)
    for card in ("<article class='teaser'><p>Another page, and what it is about, in a sentence.</p></article>", "<article><p>Read on.</p></article>"):
        assert " ".join(STORY) in extract(PAGE % (card + f"<div>{story}</div>"))


def test_short_paragraphs_cut_off_by_removed_elements_stay():
    story = "".join(f"<p>{x}</p>" for x in STORY)
    ad = "<div class='ad'>Buy</div>"
    assert extract(PAGE % f"<div><p>So it began.</p>{ad}{story}{ad}<p>The end.</p></div><div class='ad'>x</div><div>Elsewhere</div>") == " ".join(["So it began.", *STORY, "The end."])


def plain_kept(lines, links, inside, parents):
    """The definition, line by line."""
    level = max([i for i, t in zip(inside, lines) if t], default=0)
    marked = [level > 0 and i == level for i in inside]
    size = [len(t) * (MARKED if m else 0 if x >= LINKS else 1) for t, m, x in zip(lines, marked, links)]
    window = [sum(size[max(0, k - BLOCK + 1) : k + 1]) for k in range(len(size))]
    regions, now = [], None
    for k, w in enumerate(window + [0]):
        if w and now is None:
            now = k
        if not w and now is not None:
            held = [j for j in range(now, k) if j < len(size) and size[j]]
            if regions and parents[regions[-1][-1]] == parents[held[0]] and all(parents[j] < 0 for j in range(regions[-1][-1] + 1, held[0])):
                regions[-1] += held
            else:
                regions.append(held)
            now = None
    ours = [any(marked[j] for j in r) for r in regions]
    mass = [sum(size[j] for j in r) for r in regions]
    mass = [sum(m for m, o in zip(mass, ours) if o) if o else m for m, o in zip(mass, ours)]
    good = [m >= (LEAST_SHARE if o or not any(ours) else OUTSIDE_SHARE) * max(mass) for m, o in zip(mass, ours)]
    if True in good and not any(ours):
        first, last = good.index(True), len(good) - 1 - good[::-1].index(True)
        good = [first <= k <= last for k in range(len(good))]
    out = []
    for r in (r for r, ok in zip(regions, good) if ok):
        for a, b in zip(r, [*r[1:], None]):
            between = [k for k in range(a + 1, b) if lines[k]] if b is not None else []
            out += [a, *(between if len(between) < MENU else [])]
    return out


@pytest.mark.parametrize("seed", range(200))
def test_surge_and_dive_points_against_the_definition(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 60))
    blank = rng.random(n) < rng.choice([0.2, 0.5, 0.8])
    lines = ["" if b else "x" * int(2 ** rng.uniform(0, 10)) for b in blank]
    links = [float(x) for x in rng.choice([0.0, 0.59, 0.6, 1.0], n, p=[0.7, 0.1, 0.1, 0.1])]
    most = rng.choice([0, 1, 2])
    inside = [0 if b else int(x) for b, x in zip(blank, rng.integers(0, most + 1, n) * (rng.random(n) < 0.3))]
    parents = [-1 if b else int(x) for b, x in zip(blank, rng.integers(0, 4, n))]
    assert kept_lines(lines, links, inside, parents) == plain_kept(lines, links, inside, parents)


def test_letters_whose_lower_case_is_longer_shift_nothing():
    assert extract("<p>İ x20</p><script>x</script><p>abc</p><p>def ghi</p>") == "İ x20 abc def ghi"
    assert extract("<p>" + "İ" * 50 + "</p><STYLE>p{}</STYLE><p>abc</p>") == "İ" * 50 + " abc"


def test_without_marks_and_lists_the_distribution_tells_text_from_the_rest():
    story = "".join(f"<p>{x}</p>" for x in STORY)
    page = f"<body><div class='zq'>Buy this at once.</div><div><h1>What happened</h1>{story}</div><div class='zr'>Some fine print.</div></body>"
    assert extract(page) == " ".join(["What happened", *STORY])


def test_all_articles_of_a_page_are_one():
    assert extract(f"<article><p>{'long ' * 400}</p></article><div>between</div><article><p>Be.</p></article>") == " ".join(["long"] * 400 + ["Be."])


def test_equal_regions_are_kept_together():
    a = "<div><p>Some text of a length.</p></div>"
    assert extract(a + "<nav>x</nav>" + a) == "Some text of a length. Some text of a length."
