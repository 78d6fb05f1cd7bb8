import random

import numpy as np

from brute import contamination
from texloom.llm import decontam


def test_equals_brute_force(spark):
    rnd = random.Random(5)
    word = lambda: rnd.choice(["the", "of", "and", "é", "Ab", "x1", "zz"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 13, 14, 20, 40, 13, 30])]
    items += [(50, None), (51, "..."), (8, items[8][1]), (None, "the of and"), (52, "solo")]
    texts = [None, "", "!!", "x", *(" ".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(60))]
    for k, (_, t) in enumerate(items[:10]):
        texts.append(" ".join(word() for _ in range(20 * k)) + ", " + t.upper() + "; " + t)
    texts.append("SOLO " * 3 + "filler " * 2000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "1 as n_words", "'x' as item_id")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = contamination(texts, [x for x in items if x[0] is not None])
    for how in ((decontam.FILTER_BITS, 1 << 20), (decontam.FILTER_BITS, -1), (64, -1)):  # all small; shuffled; a filter that lets all pass
        got = {r[0]: tuple(r[1:]) for r in decontam.match(df, bench, *how).collect()}
        assert [got[i] for i in range(len(texts))] == want
        kept = decontam.drop_contaminated(df, bench, *how)
        assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [i for i, w in enumerate(want) if not w[4]]


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.match(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert [tuple(r)[:4] for r in decontam.match(one, bench).collect()][0][:3] == (1, 2, 0)


def test_long_texts_repeated_rows_and_clashing_names(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    long = "filler text " * 200_000
    texts = [long, long + passage, passage, passage, "A " + passage.upper(), None]
    df = spark.createDataFrame([(i if i != 3 else None, t) for i, t in enumerate(texts)], "doc_id bigint, text string").selectExpr("*", "1 as key", "2 as n_hit", "'x' as hash", "'y' as item_id")
    bench = spark.createDataFrame([("a", passage), ("b", passage), ("b", passage), ("c", "other words")], "item_id string, text string").selectExpr("*", "3 as size", "4 as no")
    want = contamination(texts, [("a", passage), ("b", passage), ("c", "other words")])
    got = sorted((str(r[0]), tuple(r[1:])) for r in decontam.match(df, bench).collect())
    assert got == sorted((str(i if i != 3 else None), w) for i, w in enumerate(want))
    kept = decontam.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]


def test_the_filter_knows_all_that_was_put_in(spark):
    bench = spark.createDataFrame([(k, " ".join(f"t{k}x{j}" for j in range(k % 30))) for k in range(200)], "item_id bigint, text string")
    items = decontam.benchmark_shingles(bench)
    uri, least = decontam.write_filter(items)
    bits = decontam._filter(uri)
    for r in items.collect():
        assert r.n >= 1 and decontam.known(np.array(r.hashes, np.int64).view(np.uint64), bits).all()
    assert least == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_a_passage_of_very_many_items(spark):
    """The ids go with the passage's windows, not with each of their places in each text."""
    import hashlib

    from pyspark.sql import functions as F

    passage = " ".join(f"w{k}" for k in range(20))
    bench = spark.range(20_000).select(F.col("id").alias("item_id"), F.lit(passage).alias("text"))
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), F.lit(passage), F.lit(" c"), F.col("id").cast("string")).alias("text"))
    want = hashlib.sha256(",".join(sorted(map(str, range(20_000)))).encode()).hexdigest()
    got = decontam.match(docs, bench)
    assert {(r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect()} == {(23, 20, 20_000, want, True)}
    assert got.count() == 300
