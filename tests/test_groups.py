"""Brace groups of any depth, and texts that hold any character."""

import random

import pytest
from pyspark.sql import functions as F

from texloom.functions import tex as T


def brute(text, head="\\caption"):
    """(groups, offsets of heads that never close) by a stack over characters; heads without options."""
    stack, done, k = [], [], 0
    while k < len(text):
        if text.startswith(head + "{", k):
            stack.append(k)
            k += len(head) + 1
        elif text[k] == "{":
            stack.append(None)
            k += 1
        elif text[k] == "}":
            if stack:
                top = stack.pop()
                if top is not None:
                    done.append((top, k + 1))
            k += 1
        else:
            k += 1
    outer = [(a, b) for a, b in done if not any(c < a and b < d for c, d in done)]
    return [text[a:b] for a, b in sorted(outer)], sorted(s for s in stack if s is not None)


def texts():
    rng = random.Random(12)
    out = ["", "plain", "\\caption{a\u0001b\u0002c} {{{{{{{{x}}}}}}}}", "\\caption{never closed", "\\caption{open \\caption{fine} {", "}}\\caption{x}}", "{open \\caption{c}", "\\caption{" + "{x" * 40 + "}" * 40 + "} \\caption{b}", "\\caption{a \\caption{b} c} \\caption{d}"]
    for _ in range(300):
        out.append("".join(rng.choice(["\\caption{", "{", "}", "}", "a", "\\", "\u0001", "\n", "é"]) for _ in range(rng.randint(0, 60))))
    return out


def test_groups_equal_a_stack(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "i int, tex string")
    rows = df.select("tex", T.groups("tex", r"\\caption").alias("g"), T.unclosed("tex", r"\\caption").alias("u"), T.with_groups(F.col("tex"), r"\\caption", "<", ">").alias("w")).collect()
    for r in rows:
        found, open_ = brute(r["tex"])
        assert r["g"] == found, r["tex"]
        assert r["u"] == open_, r["tex"]
        want, at = "", 0
        for g in found:
            k = r["tex"].index(g, at)
            want += r["tex"][at:k] + "\\caption{<" + g[9:-1] + ">}"
            at = k + len(g)
        assert r["w"] == want + r["tex"][at:]


@pytest.mark.parametrize("text, want", [("p\u0001q", ["p\u0001q"]), ("a\n\n\nb", ["a", "\n\n", "\nb"]), ("\n\n\n\n", ["\n\n", "\n\n"]), ("", [])])
def test_paragraphs(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(T.paragraphs(F.col("t"))).first()[0] == want


def test_options_with_braces(spark):
    text = "\\caption[a{b]{" + "{" * 9 + "x" + "}" * 9 + "} \\caption[s]{y}"
    found = spark.createDataFrame([(text,)], "tex string").select(T.groups("tex", T.CAPTION_HEAD)).first()[0]
    assert found == [text.split(" \\caption")[0], "\\caption[s]{y}"]
