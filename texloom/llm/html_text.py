"""HTML extraction by line-block distribution.

Markup is stripped to lines: each block of a page is a line. Removed elements
(scripts, menus, headers, footers, sidebars, notices, adverts, forms, reader
comments) leave BLOCK blank lines, and where a dividing container starts or
ends there are STEP. A line's size is the length of its text; lines that are
mostly links have none, and those in what the page marks as its article, by an
element or else by the class of a container, have MARKED times their length.
Sizes are summed over a sliding window of BLOCK lines: where the sum rises from
nothing is a surge point, where it falls back to nothing a dive point, and what
lies between is a region. Regions parted only by blank lines within one
container are one, and so are all that the page marks. A region is kept if its
size is at least LEAST_SHARE of the largest one's, and OUTSIDE_SHARE if the page
marks an article and it lies outside; without any mark the regions between two kept ones are kept too. Of a kept region every line comes out, links
between its first and last text too, but for runs of MENU lines of links and more.

A container whose class says only that it may be no text (MAYBE_TEXT: search,
share and the like) is removed if nothing in it reads as a sentence.

So marks only weigh: text outside a marked article is kept where a region of it
has MARKED * OUTSIDE_SHARE times the article's text. An article element marked as a card or
teaser is no mark. A marked article is not cut at removed elements or containers.

Defined results: a null or empty html, or one without text, gives an empty
text; whole pages of any length are read; regions of equal size are kept or
dropped together; unclosed elements end with their parent, and a removed one at
the latest where the first article begins; repeated rows get equal results; an
empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow import pieces, texts_of

#: Lines of a window, and blank lines where a removed element was.
BLOCK = 3
#: Blank lines where a dividing container starts or ends: two containers side by side are parted, one inside text is not.
STEP = 2
#: Share of the largest region's size from which a region is kept, and one outside a marked article.
LEAST_SHARE, OUTSIDE_SHARE = 0.1, 0.5
#: What text in a marked article weighs.
MARKED = 5
#: Share of a line's text in links from which it counts as a menu's, and how many such lines in a row are a menu within text.
LINKS, MENU = 0.6, 3
#: Characters from which a line reads as prose even without a full stop.
PROSE = 80

# HTML's elements by what they do to the text.
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes plaintext".split())
REMOVED = frozenset("head nav header footer aside form menu dialog button select option datalist fieldset svg math canvas audio video object embed applet figure map".split()) - {"figure", "math"}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math meter nobr output progress q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset("article main".split())
#: Elements that hold blocks and whose end tag is not optional.
CONTAINER = frozenset("div section article main blockquote center ul ol dl table fieldset details".split())
#: Elements whose start and end part lines, when they are not removed.
DIVIDING = frozenset("div section article main center fieldset details header footer aside nav".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class or id by which an article element is a card about another page.
CARD = frozenset("card cards teaser teasers".split())
#: Words of class, id, role and aria-label that mark what is not the article.
NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar masthead "
    "sidebar aside complementary widget widgets related recommended recommendations "
    "footer colophon copyright contentinfo notice notices notification alert cookie cookies consent gdpr privacy popup modal overlay dialog paywall subscribe subscription newsletter signup login "
    "comment comments commentlist respond reply replies disqus".split()
)
#: Words that stand for what is not the article only where no sentence is in it.
MAYBE_TEXT = frozenset("discussion form search share sharing social".split())
#: A container of these words alone is a page's header; one with any of the second list is its article, where no element says so.
HEADER = frozenset("header site top global main bar wrapper container inner".split())
CONTENT = frozenset("article content post entry story main maincontent".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S,
)
_MARKS = re.compile(r"(?:^|[\s\"'/])(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_SENTENCE = re.compile(r"\S+\s+\S+\s+\S.*[.!?\u2026][\"'\u201d\u00bb)]*$")


def _marks(attrs: str) -> set[str]:
    """Lower-case words of an element's class, id, role and label."""
    values = " ".join(m[1] or m[2] or m[3] or "" for m in _MARKS.finditer(attrs))
    return {w.lower() for w in _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", values))}


def _not_text(attrs: str, marks: set[str]) -> bool:
    return bool(marks & NOT_TEXT) or "header" in marks and marks <= HEADER or bool(attrs) and bool(_HIDDEN.search(attrs))


def _end_of_raw(name: str) -> re.Pattern:
    return re.compile(rf"(?ai)</{name}")


_RAW_ENDS = {name: _end_of_raw(name) for name in RAW}


def lines_of(html: str) -> tuple[list[str], list[float], list[int], list[int]]:
    """(lines, share of links, 2 in an article, 1 in an element marked as content, else 0, number of the container or -1 for blank lines) in page order."""
    lines: list[str] = []
    links: list[float] = []
    inside: list[int] = []
    parents: list[int] = []
    open_: list[tuple[str, int]] = []  # containers
    made = 0
    cards: list[bool] = []  # open article elements: whether each is a card
    text: list[str] = []
    linked = anchors = 0
    held, deep = None, 0  # an element marked as content, and how many of its name are open
    seen = False  # whether an article has begun
    removed, depth = None, 0  # the element being removed, and how many of its name are open
    doubted, within, since = None, 0, 0  # an element that may be no text, how many of its name are open, and its first line
    headed = -1  # number of lines when the last heading ended
    at, size = 0, len(html)

    def mark() -> int:
        return 2 if not all(cards) else 1 if held else 0

    def end_line() -> None:
        nonlocal linked
        joined = unescape("".join(text)) if text else ""
        if joined and not joined.isspace():
            lines.append(" ".join(joined.split()))
            links.append(min(1.0, linked / max(1, sum(map(len, text)))))
            inside.append(mark())
            parents.append(open_[-1][1] if open_ else 0)
        text.clear()
        linked = 0

    def blank(n: int) -> None:
        lines.extend([""] * n)
        links.extend([0.0] * n)
        inside.extend([0] * n)
        parents.extend([-1] * n)

    def gap() -> None:
        """Where a removed element was; a marked article goes on behind it."""
        end_line()
        if not mark():
            blank(BLOCK)

    def judge() -> None:
        """At the end of a doubted element: its lines go if none of them is a sentence."""
        nonlocal doubted
        end_line()
        doubted = None
        if not any(share < LINKS and (len(t) >= PROSE or _SENTENCE.match(t)) for t, share in zip(lines[since:], links[since:], strict=True)):
            for x in (lines, links, inside, parents):
                del x[since:]
            gap()

    while at < size:
        m = _TOKEN.search(html, at)
        upto = m.start() if m else size
        if upto > at and removed is None:
            text.append(html[at:upto])
            if anchors:
                linked += upto - at
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            if m[0].startswith("<![CDATA[") and removed is None:
                text.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name, closing = name.lower(), bool(m["close"] or m["close2"])
        attrs = m["attrs"] or m["attrs2"] or ""
        marks = _marks(attrs) if attrs and not closing and "=" in attrs else set()
        if name in RAW and not closing:
            stop = _RAW_ENDS[name].search(html, at)
            at = (html.find(">", stop.start()) + 1 or size) if stop else size
            if removed is None:
                gap()
            continue
        if removed is not None:
            if name in ARTICLE and not closing and not seen and not _not_text(attrs, marks):
                removed = None
                gap()  # and go on to the article below
            elif name == removed:
                depth += -1 if closing else 0 if attrs.endswith("/") and name in VOID else 1
                if depth == 0:
                    removed = None
                    gap()
                continue
            elif closing and name in ("body", "html") or not closing and name == "body":
                removed = None
                gap()
                continue
            else:
                continue
        drop = not closing and name not in VOID and (name in REMOVED or name not in ("html", "body") and (name not in ARTICLE or cards) and _not_text(attrs, marks))
        if drop:
            gap()
            removed, depth = name, 1
            continue
        if name == doubted:
            within += -1 if closing else 1
            if not within:
                judge()
        elif doubted is None and not closing and name in CONTAINER and name not in ARTICLE and marks & MAYBE_TEXT:
            end_line()
            doubted, within, since = name, 1, len(lines)
        if name == "a":
            anchors = 0 if closing else 1
        elif name == "br":
            text.append(" ")
        elif name not in INLINE and name not in ("img", "input"):
            end_line()
            before = mark()
            if closing and name in HEADING:
                headed = len(lines)
            if name in CONTAINER:
                if not closing:
                    made += 1
                    open_.append((name, made))
                elif any(n == name for n, _ in open_):
                    while open_.pop()[0] != name:
                        pass
            if name == held:
                deep += -1 if closing else 1
                held = held if deep else None
            elif held is None and not closing and name in ("div", "section", "td") and marks & CONTENT:
                held, deep = name, 1
            if name in ARTICLE:
                seen = True
                if not closing:
                    cards.append(bool(marks & (CARD | NOT_TEXT)))
                elif cards:
                    cards.pop()
            if before != mark():
                blank(BLOCK)
            elif not before and name in DIVIDING and headed != len(lines):  # a heading goes with what follows it
                blank(STEP)
    end_line()
    if doubted:
        judge()
    return lines, links, inside, parents


def sizes_of(lines: list[str], links: list[float], inside: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(size of each line, whether it is in what the page marks as its article); the strongest kind of mark counts."""
    level = max((i for i, t in zip(inside, lines, strict=True) if t), default=0)
    marked = np.array([bool(level) and i == level for i in inside], bool)
    length = np.array([len(t) for t in lines], np.int64)
    return length * np.where(marked, MARKED, np.array(links) < LINKS), marked


def regions_of(sizes: np.ndarray, parents: list[int]) -> list[tuple[int, int]]:
    """(surge, dive) of each region; those parted only by blank lines within a container are one."""
    if not sizes.any():
        return []
    # distribution[k]: sizes of the BLOCK lines up to k; surges where a line has text after nothing, dives where a whole window has none
    distribution = np.convolve(sizes, np.ones(BLOCK, np.int64))[: len(sizes)]
    flow = np.concatenate([[0], distribution > 0, [0]])
    out: list[tuple[int, int]] = []
    for a, b in zip(np.flatnonzero(np.diff(flow) == 1), np.flatnonzero(np.diff(flow) == -1), strict=True):
        if out:
            last = out[-1][0] + np.flatnonzero(sizes[out[-1][0] : out[-1][1]])[-1]
            if parents[last] == parents[a] and all(p < 0 for p in parents[last + 1 : a]):
                out[-1] = (out[-1][0], int(b))
                continue
        out.append((int(a), int(b)))
    return out


def kept_lines(lines: list[str], links: list[float], inside: list[int], parents: list[int]) -> list[int]:
    """The lines, by number, that the distribution keeps."""
    sizes, marked = sizes_of(lines, links, inside)
    found = regions_of(sizes, parents)
    if not found:
        return []
    ours = np.array([bool(marked[a:b].any()) for a, b in found])
    mass = np.array([sizes[a:b].sum() for a, b in found])
    mass[ours] = mass[ours].sum()
    good = mass >= np.where(ours | (not ours.any()), LEAST_SHARE, OUTSIDE_SHARE) * mass.max()
    if not ours.any():
        among = np.flatnonzero(good)
        good[among[0] : among[-1]] = True
    kept = []
    for a, b in (r for r, ok in zip(found, good, strict=True) if ok):
        text = a + np.flatnonzero(sizes[a:b])
        run: list[int] = []
        for k in range(int(text[0]), int(text[-1]) + 1):
            if sizes[k]:
                kept += [*(run if len(run) < MENU else []), k]
                run = []
            elif lines[k]:  # a line of links between texts
                run.append(k)
    return kept


def extract(html: str) -> str:
    """The page's main text."""
    found = lines_of(html)
    return " ".join(found[0][k] for k in kept_lines(*found))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = [extract(h) for h in texts_of(part, "html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
