from collections import Counter, defaultdict

from texloom.llm import linededup

ROWS = [(i, f"head\nbody {i}\n\n{'foot' if i % 2 else 'head'}\nend{i % 3 if i < 4 else i}", "h1") for i in range(12)]
ROWS += [(100, None, "h1"), (101, "", "h1"), (102, "head\nhead", None), (103, "head", "h2"), (104, "head\nx", "h2"), (104, "head\nx", "h2"), (None, "head\n ", "h2")]


def brute(rows, ratio, least):
    pages, having = Counter(r[2] for r in rows), defaultdict(Counter)
    for _, text, host in rows:
        having[host].update({x for x in (text or "").split("\n") if x.strip(" ")})
    out = []
    for i, text, host in rows:
        if host is None or text is None:
            out.append((i, text))
        else:
            out.append((i, "\n".join(x for x in text.split("\n") if not (x.strip(" ") and having[host][x] >= least and having[host][x] > ratio * pages[host]))))
    return out


def test_equals_brute_force_on_both_joins(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, source string")
    for limit in (1 << 20, -1):
        found = linededup.drop_boilerplate(df, broadcast_bytes=limit)
        assert found.columns == df.columns
        assert sorted([(r.doc_id, r.text) for r in found.collect()], key=str) == sorted(brute(ROWS, 0.1, 3), key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string, n_lines int")
    assert linededup.drop_boilerplate(df).count() == 0


def test_long_texts_and_clashing_names(spark):
    rows = [(i, "head\n" + f"line {i} " * 100_000 + "\nown", "h") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "7 as n_lines", "'x' as n_dropped", "1 as _key")
    for limit in (1 << 20, -1):
        found = linededup.drop_boilerplate(df, broadcast_bytes=limit, counted=True)
        assert sorted(found.columns) == sorted(df.columns)
        assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text == rows[r.doc_id][1].split("\n")[1]) for r in found.collect()) == [(i, 3, 2, True) for i in range(4)]
    assert linededup.drop_boilerplate(df).columns == df.columns
