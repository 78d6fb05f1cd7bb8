import random

import brute

from texloom.llm import nearcopies


def words(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    return len(words(a) & words(b)) / len(words(a) | words(b))


def test_keeps_no_two_similar_documents(spark):
    rnd = random.Random(5)
    texts = []
    for _ in range(30):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(100, 400))]
        texts.append(" ".join(base))
        for changes in (2, 4, 6):
            other = list(base)
            for _ in range(changes):
                other[rnd.randrange(len(base))] = "changed"
            texts.append(" ".join(other))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if similarity(texts[i], texts[j]) >= 0.8]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = {r.doc_id for r in nearcopies.keep_one(df).collect()}
    assert len(pairs) > 50 and not [p for p in pairs if kept >= set(p)]
    assert {4 * k for k in range(30)} <= kept  # the first of each group stays


def test_large_groups_and_edges(spark):
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base[:k] + ["x" + str(k)] + base[k + 1 :]) for k in range(0, 400, 4)]  # more than a small bucket
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (None, texts[3]), (902, "one two"), (903, "ONE two"), (904, " ".join(rnd.sample(base, 400)))], "doc_id bigint, text string").selectExpr("*", "1 as sig")
    kept = nearcopies.keep_one(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [0, 900, 902, 904, None]
    assert nearcopies.keep_one(df.where("false")).count() == 0


def test_recall_on_large_mixed_buckets(spark):
    """Families of near copies that resemble one another at about 0.6 share buckets of far more than SMALL texts."""
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(9000)}" for _ in range(300)]
    rows = []
    for family in range(5):
        own = list(base)
        for _ in range(14):
            own[rnd.randrange(300)] = f"f{family}-{rnd.randrange(9000)}"
        for _ in range(60):
            text = list(own)
            for _ in range(rnd.randint(1, 7)):
                text[rnd.randrange(300)] = f"v{rnd.randrange(9000)}"
            rows.append((len(rows), " ".join(text)))
    want = brute.similar_groups(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    buckets = nearcopies.band_buckets(nearcopies.signed(df).groupBy("sig").agg(*(nearcopies.F.first(c).alias(c) for c in ("fp", "n", "bands"))))
    assert buckets.agg({"many": "max"}).first()[0] > 2 * nearcopies.SMALL
    kept = {r.doc_id for r in nearcopies.keep_one(df).collect()}
    groups = set(want.values())
    assert groups <= kept and len(kept) <= 1.05 * len(groups), (len(kept), len(groups))


def test_pairs_of_large_buckets_are_exact(spark):
    """Every similar pair of different groups, among many texts that resemble one another less."""
    import random

    from pyspark.sql import functions as F

    from texloom.llm import nearcopies

    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for k in range(60):
        own = [w if rng.random() > 0.06 else f"x{k}-{i}" for i, w in enumerate(base)]
        texts += [" ".join(own), " ".join([*own[:-1], f"y{k}"])]
    docs = spark.createDataFrame(list(enumerate([*texts, "", "one"])), "doc_id bigint, text string")
    rows = docs.select(nearcopies._sig().alias("sig"), "text").collect()
    sets = {r["sig"]: nearcopies.shingles(r["text"]) for r in rows}
    members = spark.createDataFrame([((s, len(x)), s) for s, x in sets.items()], "t struct<sig:bigint,n:int>, root bigint").withColumn("band", F.lit(0))
    found = {frozenset((r["u"]["sig"], r["v"]["sig"])) for r in nearcopies.exact_pairs(docs, members).collect()}
    want = {frozenset((a, b)) for a in sets for b in sets if a < b and nearcopies.similar(sets[a], sets[b])}
    assert len(want) >= 60 and want <= found


def groups_of(pairs):
    groups = {}
    for a, b in pairs:
        both = groups.get(a, {a}) | groups.get(b, {b})
        groups |= dict.fromkeys(both, both)
    return groups


def test_exact_join_of_one_family_does_not_pair_all(spark):
    """Texts made from one base, each with changes of its own, resemble one another at 0.4 to 0.9; few pairs are candidates, and no link is lost."""
    rnd = random.Random(11)
    base = [f"w{k}" for k in range(240)]
    texts = []
    for k in range(150):
        own = list(base)
        for i in rnd.sample(range(240), rnd.randint(2, 14)):
            own[i] = f"x{k}-{i}"
        texts.append(" ".join(own))
        if k % 5 == 0:
            texts.append(" ".join([*own[:-1], f"y{k}"]))
    docs = spark.createDataFrame(list(enumerate([*texts, "", " ", "one"])), "doc_id bigint, text string")
    sets = {r["sig"]: nearcopies.shingles(r["text"]) for r in docs.select(nearcopies._sig().alias("sig"), "text").collect()}
    members = spark.createDataFrame([((s, len(x)), s, 1, k) for s, x in sets.items() for k in range(1 + (s % 3 == 0))], "t struct<sig:bigint,n:int>, root bigint, band int, value int")
    pairs = nearcopies.exact_pairs(docs, members)
    assert pairs.count() < 5 * len(sets)
    found = [(r["u"], r["v"]) for r in nearcopies.verified(docs, pairs).collect()]
    want = [(a, b) for a in sets for b in sets if a < b and nearcopies.similar(sets[a], sets[b])]
    assert len(want) > len(sets) and set(found) <= set(want) and groups_of(found) == groups_of(want)


def test_mixed_buckets_take_one_more_round(spark, monkeypatch):
    """Chains of texts, each a near copy of the next and not of a centre further on, are linked by one exact join: candidates are verified twice, however long the chains."""
    rnd = random.Random(13)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for chain in range(3):
        own = list(base)
        for i in rnd.sample(range(300), 12):
            own[i] = f"c{chain}-{i}"
        for k in range(40):
            own = list(own)
            own[rnd.randrange(300)] = f"x{chain}-{k}"
            rows.append((len(rows), " ".join(own)))
    calls = []
    monkeypatch.setattr(nearcopies, "verified", lambda *a, f=nearcopies.verified: calls.append(1) or f(*a))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in nearcopies.keep_one(df).collect()}
    assert len(calls) == 2 and kept == set(brute.similar_groups(rows).values())
