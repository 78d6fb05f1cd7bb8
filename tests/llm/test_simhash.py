import random

from brute import component_of, fingerprint
from texloom.llm import simhash

TEXTS = [None, "", " \t", "One two", "one two", "ONE TWO three", "É a b c", "é a b c", "a b c d e", "x " * 50]


def test_fingerprints():
    rnd = random.Random(2)
    texts = TEXTS + [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 200))) for _ in range(50)]
    assert [simhash.fingerprint(t or "") for t in texts] == [fingerprint(t) for t in texts]


def test_links_and_components_on_dense_balls(spark):
    rnd = random.Random(4)
    fps = set()
    for _ in range(6):
        x = rnd.getrandbits(64)
        for _ in range(60):
            for _ in range(rnd.randint(0, 3)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps |= {rnd.getrandbits(64) for _ in range(100)} | {0, 1, 1 << 63, 3, 7}
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    want = component_of([(x, x % (1 << 64)) for x in sorted(signed)])
    assert {x: roots.get(x, x) for x in signed} == want


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = TEXTS + [base, base, base + " end", base.replace("w7 ", "v7 "), base.upper()]
    df = spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id bigint, text string").selectExpr("*", "'x' as fingerprint", "1 as fp", "2 as root")
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(df).collect()}
    fps = [(i + 5, fingerprint(t)) for i, t in enumerate(texts)]
    want = component_of(fps)
    assert got == {i: (f, want[i]) for i, f in fps}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_empty_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(df).count() == 0
    some = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c")], "doc_id bigint, text string")
    assert sorted(map(tuple, simhash.near_duplicates(some).select("doc_id", "component_id").collect()), key=str) == [(4, 4), (4, 4), (None, 4)]
    assert simhash.keep_one(some).count() == 3
