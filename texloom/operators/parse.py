"""A linear LaTeX parser: tokens, a tree with source offsets, and segments of a document.

Commands take arguments greedily (brackets, braces, and one more round of each)
unless their arity is fixed; verbatim-like environments are not parsed. A text
that cannot be parsed gives a row with its error, never a failed job.
"""

from __future__ import annotations

import contextlib
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from .. import schema as S

# Environments whose body is text, those in math mode, commands of fixed arity (required, optional), and what may follow a size command.
VERBATIM = frozenset("lstlisting verbatim verbatimtab Verbatim listing".split())
MATH = frozenset("align align* alignat array displaymath eqnarray eqnarray* equation equation* flalign flalign* gather gather* math multline multline* split".split())
ARITY = {"def": (2, 0), "textbf": (1, 0), "section": (1, 1), "label": (1, 0), "cap": (0, 0), "cup": (0, 0), "in": (0, 0), "notin": (0, 0), "infty": (0, 0), "noindent": (0, 0)}
SIZES = "left right big Big bigg Bigg".split()
DELIMITERS = ["(", ")", "<", ">", "[", "]", "{", "}", r"\{", r"\}", ".", "|", r"\langle", r"\rangle", r"\lfloor", r"\rfloor", r"\lceil", r"\rceil", r"\ulcorner", r"\urcorner", r"\lbrack", r"\rbrack"]

_LEXER = re.compile(
    r"(?P<Escaped>\\[^A-Za-z\[\]()\x00\x7f])"
    r"|(?P<Comment>%[^\n]*)"
    r"|(?P<DisplayMath>\$\$)|(?P<Math>\$)"
    r"|(?P<MathBegin>\\[(\[])|(?P<MathEnd>\\[)\]])"
    r"|(?P<Ignored>[\x00\x7f]+)"
    r"|(?P<Spacer>(?:[ \t]*\n[ \t]*|[ \t]+)(?=[\\{}$\[\]%\n]|\Z))"
    rf"|\\(?P<Punctuation>(?:{'|'.join(SIZES)})(?:{'|'.join(map(re.escape, DELIMITERS))}))"
    r"|\\(?P<Command>[A-Za-z]+\*?)|(?P<Escape>\\)"
    r"|(?P<GroupBegin>\{)|(?P<GroupEnd>\})|(?P<BracketBegin>\[)|(?P<BracketEnd>\])"
    r"|(?P<Text>[^\\{}$\[\]%\x00\x7f]+)"
)


def tokens(tex: str) -> Iterator[tuple[int, str, str]]:
    """(offset, category, text); a command's token begins with its backslash."""
    for m in _LEXER.finditer(tex):
        yield m.start(), m.lastgroup, m[0]


#: Tokens that more than a text begins with.
_OPENING = frozenset("Math DisplayMath MathBegin Command GroupBegin Punctuation".split())
#: What a text has instead of arguments and a body.
_NONE: tuple = ()


class ParseError(ValueError):
    """A text that is no LaTeX; says where."""


@dataclass(slots=True)
class Node:
    kind: str  # env, math, cmd, item, group, bracket, text
    name: str
    start: int
    stop: int = 0
    begin: str = ""
    end: str = ""
    args: Sequence[Node] = field(default_factory=list)
    body: Sequence[Node] = field(default_factory=list)
    body_start: int = 0


class Parser:
    """Parses one text; `tolerant` accepts environments that are not closed."""

    def __init__(self, tex: str, tolerant: bool = False, verbatim: frozenset[str] = VERBATIM):
        self.tex, self.tolerant, self.verbatim = tex, tolerant, verbatim
        self.toks = [*tokens(tex), (len(tex), "End", "")]  # no step goes beyond the end
        self.at = 0
        self.closed = self._closed()

    def _closed(self) -> set[int]:
        """Offsets of brackets that close within their group; the others are text."""
        found, open_ = set(), []
        for start, kind, _ in self.toks:
            if kind in ("GroupBegin", "BracketBegin"):
                open_.append((kind, start))
            elif kind == "BracketEnd" and open_ and open_[-1][0] == "BracketBegin":
                found.add(open_.pop()[1])
            elif kind == "GroupEnd":
                while open_ and open_.pop()[0] != "GroupBegin":
                    pass
        return found

    def peek(self, k: int = 0) -> tuple[int, str, str]:
        at = self.at + k
        return self.toks[at] if at < len(self.toks) else self.toks[-1]

    def fail(self, what: str, start: int):
        line = self.tex.count("\n", 0, start)
        raise ParseError(f"[Line: {line}, Offset: {start - self.tex.rfind(chr(10), 0, start) - 1}] {what}")

    def document(self) -> Node:
        root = Node("root", "[tex]", 0, len(self.tex))
        while self.toks[self.at][1] != "End":
            root.body.append(self.expression(False))
        return root

    def expression(self, math: bool) -> Node:
        start, kind, text = self.toks[self.at]
        self.at += 1
        if kind not in _OPENING:
            return Node("text", "", start, start + len(text), text, "", _NONE, _NONE)
        if kind == "Command":
            return self.command(start, text[1:], math)
        if kind == "GroupBegin":
            return self.group("group", start, "GroupEnd", math)
        if kind == "Punctuation":
            return Node("cmd", text[1:], start, start + len(text), begin=text)
        return self.math(start, kind, text)

    def group(self, kind: str, start: int, closing: str, math: bool) -> Node:
        node = Node(kind, "", start, begin=self.tex[start], end="}" if kind == "group" else "]", body_start=start + 1)
        toks, add = self.toks, node.body.append
        while (found := toks[self.at][1]) != closing:
            if found == "End":
                if self.tolerant:
                    node.stop = len(self.tex)
                    return node
                self.fail("Malformed argument: not closed.", start)
            add(self.expression(math))
        node.stop = toks[self.at][0] + 1
        self.at += 1
        return node

    def math(self, start: int, kind: str, text: str) -> Node:
        want = {"$": "$", "$$": "$$", r"\(": r"\)", r"\[": r"\]"}[text]
        node = Node("math", {r"\(": "math", r"\[": "displaymath"}.get(text, text), start, begin=text, end=want, body_start=start + len(text))
        while self.peek()[2] != want:
            if self.peek()[1] == "End":
                if self.tolerant:
                    node.stop = len(self.tex)
                    return node
                self.fail(f"Expecting {want}.", start)
            node.body.append(self.expression(True))
        node.stop = self.peek()[0] + len(want)
        self.at += 1
        return node

    def command(self, start: int, name: str, math: bool) -> Node:
        if name == "begin":
            return self.environment(start, math)
        node = Node("item" if name == "item" else "cmd", name, start, start + len(name) + 1, begin="\\" + name)
        if name == "item":
            if math:
                self.fail(r"Command \item invalid in math mode.", start)
            self.optional(node, 1, math)
            node.body_start = node.stop
            toks, add = self.toks, node.body.append
            while True:
                _, kind, text = toks[self.at]
                if kind in ("End", "GroupEnd") or kind == "Command" and text in (r"\item", r"\end"):
                    break
                add(self.expression(math))
            node.stop = node.body[-1].stop if node.body else node.stop
            return node
        required, optional = ARITY.get(name, (-1, -1))
        if (required, optional) != (0, 0):
            optional = self.optional(node, optional, math)
            required = self.required(node, required, math)
            if self.peek()[1] == "BracketBegin" and optional:
                self.optional(node, optional, math)
            if self.peek()[1] == "GroupBegin" and required:
                self.required(node, required, math)
        return node

    def _next_is(self, kind: str) -> int:
        """Tokens to skip until one of a kind, with white space of one newline at most between; -1 if there is none."""
        first = self.toks[self.at][1]
        if first == kind:
            return 0
        if first != "Spacer" and first != "Text":
            return -1
        k = 0
        while self.peek(k)[1] == "Spacer" or self.peek(k)[1] == "Text" and self.peek(k)[2].isspace():
            k += 1
        if self.peek(k)[1] != kind:
            return -1
        between = "".join(self.peek(j)[2] for j in range(k))
        return k if between.count("\n") < 2 else -1

    def _take(self, node: Node, many: int, opening: str, closing: str, kind: str, math: bool) -> int:
        while many and (k := self._next_is(opening)) >= 0:
            start = self.peek(k)[0]
            if kind == "bracket" and start not in self.closed:
                break
            self.at += k + 1
            node.args.append(self.group(kind, start, closing, math))
            node.stop = node.args[-1].stop
            many -= 1
        return many

    def optional(self, node: Node, many: int, math: bool) -> int:
        return self._take(node, many, "BracketBegin", "BracketEnd", "bracket", math)

    def required(self, node: Node, many: int, math: bool) -> int:
        many = self._take(node, many, "GroupBegin", "GroupEnd", "group", math)
        while many > 0:
            k = 0
            while self.peek(k)[1] == "Spacer":
                k += 1
            start, kind, text = self.peek(k)
            if kind in ("End", "GroupEnd", "Comment") or kind == "GroupBegin":
                break
            self.at += k + 1
            if kind == "Text":  # the next character is the argument
                skip = len(text) - len(text.lstrip(" \t"))
                start, rest = start + skip, text[skip + 1 :]
                if rest:
                    self.at -= 1
                    self.toks[self.at] = (start + 1, "Text", rest)
                text = text[skip : skip + 1]
            node.args.append(Node("group", "", start, start + len(text), body=[Node("text", "", start, start + len(text), begin=text)], body_start=start))
            node.stop = start + len(text)
            many = self._take(node, many - 1, "GroupBegin", "GroupEnd", "group", math)
        return many

    def environment(self, start: int, math: bool) -> Node:
        k = self._next_is("GroupBegin")
        if k < 0:
            self.fail("Begin command must be followed by an env name.", start)
        self.at += k + 1
        label = self.group("group", self.peek(-1)[0], "GroupEnd", math)
        name = self.tex[label.start + 1 : label.stop - 1]
        node = Node("env", name, start, label.stop, begin=self.tex[start : label.stop])
        end = re.compile(rf"\\end\s*\{{{re.escape(name)}\}}")
        if name in self.verbatim:
            m = end.search(self.tex, label.stop)
            if not m:
                if not self.tolerant:
                    self.fail(f"\\begin{{{name}}} is not closed.", start)
                stop, node.stop = len(self.tex), len(self.tex)
            else:
                stop, node.stop, node.end = m.start(), m.end(), m[0]
            node.body_start = label.stop
            if stop > label.stop:
                node.body.append(Node("text", "", label.stop, stop, begin=self.tex[label.stop : stop]))
            while self.peek()[0] < node.stop:
                self.at += 1
            # a percent sign in the body is no comment: what its token holds of the text behind the end is cut anew
            last, _, text = self.toks[self.at - 1]
            if last + len(text) > node.stop:
                self.toks[self.at : self.at] = [(node.stop + k, *t) for k, *t in tokens(self.tex[node.stop : last + len(text)])]
            return node
        spare = self.optional(node, -1, math)
        self.required(node, -1, math)
        if self.peek()[1] == "BracketBegin":
            self.optional(node, spare, math)
        node.body_start = node.stop
        math = math or name in MATH
        toks, add = self.toks, node.body.append
        while True:
            at, kind, text = toks[self.at]
            if kind == "End" or kind == "Command" and text == r"\end":
                break
            add(self.expression(math))
        m = end.match(self.tex, at) if kind != "End" else None
        if not m:
            if not self.tolerant:
                self.fail(f"\\begin{{{name}}} is not closed.", start)
            node.stop = at
            return node
        node.stop, node.end = m.end(), m[0]
        while self.peek()[0] < node.stop:
            self.at += 1
        return node


#: Frames that one nested group or argument takes at most, and those around it.
_FRAMES, _SPARE = 6, 2000


@contextlib.contextmanager
def _deep(marks: int) -> Iterator[None]:
    """Room for as many nested calls as a text has opening marks: frames of Python functions lie on the heap."""
    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, _FRAMES * marks + _SPARE))
    try:
        yield
    finally:
        sys.setrecursionlimit(before)


def _opening_marks(tex: str) -> int:
    """No text nests deeper than it has these."""
    return tex.count("{") + tex.count("[") + tex.count("$") + tex.count("\\(") + tex.count("\\begin") + tex.count("\\item")


def parse(tex: str, tolerant: bool = False) -> Node:
    """The tree of a text, however deep it nests."""
    with _deep(_opening_marks(tex)):
        return Parser(tex, tolerant).document()


def rows_of(root: Node, tex: str, kept: Callable[[Node, Node, str], bool] | None = None) -> list[tuple]:
    """Nested-set rows of schema.NODES (with char_end) of a tree, in pre-order, by an explicit stack.

    kept(node, parent, slot): which nodes have a row; all are numbered.
    """
    out: list[list] = []
    clock = number = 0
    stack: list[tuple | list | None] = [(n, root, None, 0, "content", i) for i, n in reversed(list(enumerate(root.body)))]
    while stack:
        top = stack.pop()
        if top.__class__ is not tuple:  # a node's end
            if top is not None:
                top[1] = clock
            clock += 1
            continue
        node, parent, above, depth, slot, place = top
        pre, row = number, None
        number += 1
        if kept is None or kept(node, parent, slot):
            row = [pre, clock, above, depth, slot, place, node.kind, node.name, node.begin, node.end, node.begin if node.kind == "text" else None, node.start, node.stop]
            out.append(row)
        if not node.body and not node.args:
            clock += 1
            continue
        stack.append(row)
        for where, held in (("content", node.body), ("arg", node.args)):
            stack += [(held[i], node, pre, depth + 1, where, i) for i in range(len(held) - 1, -1, -1)]
    return [tuple(r) for r in out]


_OPAQUE = frozenset(S.MATH_ENVS) - {"$", "math"} | frozenset(S.ALGORITHMS + S.TABULARS + S.LISTS + S.OPAQUE_ENVS)
_INLINE = frozenset(S.INLINE_COMMANDS)
_BREAK = re.compile(r"(\n\n)")


def segments_of(tex: str, nodes: list[Node]) -> list[tuple[int, str, str, str]]:
    """(depth, kind, name, text) in order, whose texts add up to the nodes' source.

    Commands and environments that follow text without a newline belong to the text; captured environments are opaque; text is cut at empty lines.
    """
    out: list[tuple[int, str, str, str]] = []

    def emit(depth: int, text: str) -> None:
        if out and out[-1][:2] == (depth, "text"):
            text = out.pop()[3] + text
        out.extend((depth, "text", "", p) for p in _BREAK.split(text) if p)

    def glued(depth: int) -> bool:
        return bool(out) and out[-1][:2] == (depth, "text") and not out[-1][3].endswith("\n")

    def walk(nodes: list[Node], start: int, stop: int, depth: int) -> None:
        at = start
        for n in nodes:
            if n.start > at:  # white space between arguments, or what the lexer ignores
                emit(depth, tex[at : n.start])
            whole, at = tex[n.start : n.stop], n.stop
            if n.kind == "text" or n.kind == "item" or n.kind in ("env", "math") and n.name in S.INLINE_MATH:
                emit(depth, whole)
            elif n.kind in ("env", "math") and n.name in _OPAQUE:
                out.append((depth, "captured", n.name, whole))
            elif n.kind == "cmd" and n.name in ("def", "label"):
                out.append((depth, "command", n.name, whole))
            elif n.kind == "cmd" and n.name in _INLINE:
                emit(depth, whole)
            elif n.kind in ("env", "math", "cmd") and glued(depth):
                emit(depth, whole)
            elif n.kind == "cmd":
                out.append((depth, "command", n.name, whole))
            elif n.kind in ("env", "math"):
                close = n.stop - len(n.end)
                out.append((depth, "begin", n.name, tex[n.start : n.body_start]))
                walk(n.body, n.body_start, close, depth + 1)
                out.append((depth, "end", n.name, tex[close : n.stop]))
            else:
                out.append((depth, "group", "{", tex[n.start : n.body_start]))
                walk(n.body, n.body_start, n.stop - 1, depth + 1)
                out.append((depth, "group", "}", tex[n.stop - 1 : n.stop]))
        if stop > at:
            emit(depth, tex[at:stop])

    with _deep(_opening_marks(tex)):
        walk(nodes, 0, len(tex), 0)
    return out


def sliced(batch: pa.RecordBatch, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of tex each, and at least one row."""
    start = held = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column("tex")).to_pylist()):
        if i > start and held + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if batch.num_rows:
        yield batch.slice(start)


def _expanded(docs: DataFrame, rows, columns: str) -> DataFrame:
    """A row for each that rows(tex) gives; a text that fails has one row with its error and nulls."""
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = [{"int": pa.int32(), "string": pa.string(), "bigint": pa.int64()}[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                out = []
                for doc_id, tex in zip(part.column("doc_id").to_pylist(), part.column("tex").to_pylist(), strict=True):
                    try:
                        out += [(doc_id, *r, None) for r in rows(tex or "")]
                    except ParseError as e:
                        out.append((doc_id, *[None] * len(names), str(e)[:500]))
                columns_ = list(zip(*out, strict=True)) or [[]] * (len(names) + 2)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns_, [part.schema.field("doc_id").type, *kinds, pa.string()], strict=True)], ["doc_id", *names, "error"])

    return docs.select("doc_id", "tex").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}, error string")


def parse_nodes(docs: DataFrame, tolerant: bool = False, names: list[str] | None = None, parts: tuple[str, ...] = (), kinds: list[str] | None = None, above: bool = False, columns: list[str] | None = None, sources: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, schema.NODES, char_end, error; with sources also source, before error.

    Where not all nodes are needed they get no rows, but the others keep their numbers: names, kinds: only nodes of these; parts: and
    what stands in these slots (arg, content) of them; above: and all that they stand in. columns: only these, in the order of all.
    sources: slots whose nodes have the text that they span as source, so that tree.source and what uses it don't read the documents again.
    """
    every = f"{S.NODES}, char_end int".split(", ") + ["source string"] * bool(sources)
    at = [i for i, c in enumerate(every) if columns is None or c.split()[0] in columns]
    named, of = None if names is None else set(names), None if kinds is None else set(kinds)

    def meant(n: Node) -> bool:
        return (named is None or n.name in named) and (of is None or n.kind in of)

    def holders(root: Node) -> set[int]:
        """Nodes (by id) that meant ones stand in, at any depth."""
        found: set[int] = set()
        stack: list[tuple[Node, tuple | None]] = [(n, None) for n in root.body]
        while stack:
            node, path = stack.pop()
            if meant(node):
                up = path
                while up is not None and id(up[0]) not in found:
                    found.add(id(up[0]))
                    up = up[1]
            stack += [(n, (node, path)) for n in (*node.args, *node.body)]
        return found

    def rows(tex: str) -> list[tuple]:
        root = parse(tex, tolerant)
        if named is None and of is None:
            found = rows_of(root, tex)
        else:
            over = holders(root) if above else ()
            found = rows_of(root, tex, lambda n, parent, slot: meant(n) or slot in parts and meant(parent) or id(n) in over)
        if sources:
            found = [(*r, tex[r[11] : r[12]] if r[4] in sources else None) for r in found]
        return found if columns is None else [tuple(r[i] for i in at) for r in found]

    return _expanded(docs, rows, ", ".join(every[i] for i in at))


def lex(docs: DataFrame) -> DataFrame:
    """doc_id, schema.TOKENS, error."""
    return _expanded(docs, lambda tex: [(i, *t) for i, t in enumerate(tokens(tex))], S.TOKENS)


def parse_segments(docs: DataFrame) -> DataFrame:
    """doc_id, schema.SEGMENTS, error."""
    return _expanded(docs, lambda tex: [(i, *s) for i, s in enumerate(segments_of(tex, parse(tex).body))], S.SEGMENTS)


def group_of(text: str) -> tuple[str, str]:
    """(kind, inside) of a string in brackets or braces; anything else is an error."""
    for kind, a, b in (("bracket", "[", "]"), ("group", "{", "}")):
        if text.startswith(a) and text.endswith(b) and len(text) > 1:
            return kind, text[1:-1]
    raise TypeError(f"no group: {text[:40]}")


