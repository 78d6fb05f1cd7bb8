import numpy as np
import pytest

from brute import rules
from texloom.llm import quality

TEXTS = [None, "", "  \n\t ", "a " * 9, "one two three", "w1 w2 w3 w4 w5 w6 w7 w8 " * 2 + "x", "###\n###\nabé $ | <\n\n\nabé $ | <", " a b c\x1cd", "x\r\ny\r\ny\r\n", " ".join(f"word{i}" for i in range(5000)) + " tail" * 40]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, i, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int, kept string")


def test_base_statistics_equal_brute_force(spark):
    df = docs(spark, TEXTS)
    rows = quality.score_documents(df, quality.fit(df, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows} == {i: rules(t) for i, t in enumerate(TEXTS)}
    assert all(r.kept == (not r.base_failed) for r in rows)  # no labels: only the base rule


def test_repeats_on_random_texts():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("ab"), rng.integers(0, 60))) for _ in range(200)]
    base, _ = quality.rule_statistics(texts)
    assert [tuple(r) for r in base] == [rules(t)[:5] for t in texts]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    forest = quality.fit(table, labels.where("doc_id % 2 = 0"))
    judged = quality.score_documents(table, forest).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    clean, junk = judged[(judged.quality == 1) & ~judged.base_failed], judged[judged.quality == 0]
    assert clean.kept.mean() > 0.99
    assert 1 - junk.kept.mean() > 0.9


def test_filter_keeps_columns_and_empty_table(spark):
    df = docs(spark, ["clean words here " + " ".join(f"w{i}" for i in range(30)), "x"])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    kept = quality.keep_good(df, none)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [0]
    assert quality.keep_good(df.where("false"), none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_forest_of_any_size(n):
    rows = np.random.default_rng(1).normal(size=(n, 3))
    forest = quality.calibrated(quality.grow_forest(rows), rows, np.ones(n))
    assert (forest.scores(rows) <= forest.threshold).mean() >= 0.99 if n else True


def test_repeated_rows_do_not_weigh_on_the_fit(spark):
    d = "/root/testdata/sf0.001"
    table, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    once, often = quality.fit(table, labels), quality.fit(table.union(table.where("doc_id < 20")).union(table.where("doc_id = 3")), labels.union(labels))
    assert once.threshold == often.threshold and (once.cut == often.cut).all()


def plain_score(forest, row):
    """The isolation forest's definition: walk each tree to its leaf."""
    total = 0.0
    for t in range(len(forest.feature)):
        node = 0
        while forest.feature[t][node] >= 0:
            node = (forest.left if row[forest.feature[t][node]] < forest.cut[t][node] else forest.right)[t][node]
        total += forest.depth[t][node]
    return 2 ** (-total / len(forest.feature) / forest.usual)


def test_kept_equals_a_plain_isolation_forest(spark):
    d = "/root/testdata/sf0.001"
    table, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    forest = quality.fit(table, labels)
    texts = {r.doc_id: r.text for r in table.collect()}
    _, features = quality.rule_statistics(list(texts.values()))
    want = {i: (s := plain_score(forest, row), not rules(t)[5] and s <= forest.threshold) for (i, t), row in zip(texts.items(), features)}
    got = {r.doc_id: (r.score, r.kept) for r in quality.score_documents(table, forest).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[i][0] - want[i][0]) < 1e-9 and got[i][1] == want[i][1] for i in want)


def test_trees_part_their_samples_and_paths_are_short_for_outliers():
    rng = np.random.default_rng(2)
    rows = np.vstack([rng.normal(size=(500, 3)), [[30, -30, 30]]])
    forest = quality.grow_forest(rows[:500])
    scores = forest.scores(rows)
    assert scores[500] > scores[:500].max()
    for t in range(8):  # a leaf's depth is its steps and the mean rest of a search among its rows
        inner = forest.feature[t] >= 0
        assert (forest.depth[t][~inner & (forest.depth[t] > 0)] <= 2 * np.ceil(np.log2(256)) + quality._mean_depth(256)).all()


def test_the_threshold_comes_from_rows_that_the_trees_have_not_seen(spark):
    d = "/root/testdata/sf0.001"
    table, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = labels.selectExpr("*", "pmod(xxhash64(doc_id), 2) = 1 as held")
    a = quality.fit(table, labels)
    b = quality.fit(table, held.selectExpr("doc_id", "if(held, 1 - quality, quality) as quality", "toxic"))
    assert (a.cut == b.cut).all() and a.threshold != b.threshold
