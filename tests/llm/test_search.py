import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from texloom.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id bigint, text string, item_id string, score double", "item_id bigint, text string, doc_id int"


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def brute(docs, items):
    """(item, rank, doc, score), all documents scored by the formula."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    big_n, big_l = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in wanted.items():
        scored = []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in words if c[w])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:10])]
    return sorted(out, key=repr)


def run(spark, docs, items):
    left = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in docs], DOCS)
    right = spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in search.rank(left, right).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def tables():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["Äß", "naïve", "it", "IT", "K"]
    weights = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, rng.choice([" ", ", ", "  ", "'"]).join(rng.choices(words, weights, k=rng.randint(1, 60)))) for k in range(400)]
    docs += [(900 + k, docs[5][1]) for k in range(40)]  # ties
    docs += [(5, docs[5][1]), (None, docs[5][1]), (None, docs[6][1]), (1000, None), (1001, ""), (1002, "-- !"), (1003, "w1 " * 30000 + "w59")]
    items = [(k, " ".join(rng.choices(words, weights, k=rng.randint(1, 12)))) for k in range(40)]
    items += [(3, "w59 w58"), (None, "w3 naïve"), (50, None), (51, ""), (52, "unknown"), (53, docs[5][1])]
    return docs, items


def test_equals_brute_force(spark, tables):
    assert run(spark, *tables) == brute(*tables)


def test_many_blocks_change_nothing(spark, tables, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_BYTES", 200)
    assert run(spark, *tables) == brute(*tables)


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(search, "CUT_BYTES", 7)
    assert [w for part in search.cut_terms(b"Ab cd-EF gh " * 50) for w in part] == [b"ab", b"cd", b"ef", b"gh"] * 50


def test_max_score_equals_whole_sums():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        lists = []
        for _ in range(int(rng.integers(1, 9))):
            docs = np.flatnonzero(rng.random(n) < rng.random())
            if len(docs):
                lists.append((docs, rng.integers(0, int(rng.choice([2, 50, 5000])), len(docs))))
        if not lists:
            continue
        want = np.zeros(n, np.int64)
        for docs, values in lists:
            want[docs] += values
        least = int(rng.choice([1, int(want.max()), max(1, int(np.median(want)))]))
        docs, scores = search.max_score(lists, n, least)
        top = sorted(range(n), key=lambda d: (-want[d], d))[: search.BEST]
        found = dict(zip(docs.tolist(), scores.tolist()))
        assert all(found.get(d) == want[d] for d in top if want[d] >= max(least, 1))
        assert all(want[d] == s for d, s in found.items())


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] and run(spark, [(1, "a")], []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_a_row_group_of_the_index_holds_few_shards(spark):
    """Readers and writers hold a whole row group, so it must not grow with the documents of a task."""
    import pyarrow.parquet as pq

    docs = spark.range(0, 120, 1, 1).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 20000), x -> hex(xxhash64(x, id)))) as text")
    files = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")) for f in search.index(docs).inputFiles()]
    sizes = [f.metadata.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert sum(sizes) == 10 and max(sizes) <= 3
