import random
import zlib

import pytest

from texloom.llm import queries, toxicity

D = "/root/testdata/sf0.1"
DOCS, LABELS = "doc_id bigint, text string, score int, toxic string", "doc_id bigint, toxic int, text string"


def learnable(ids):
    return [i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2]


@pytest.fixture(scope="module")
def biased():
    """Toxic sentences name one group far more often than clean ones do, and half of them say nothing else that can be learned."""
    rng = random.Random(2)
    neutral = "the market opened early and people walked home after lunch while rain fell over green hills".split()
    ids, rows, labels = learnable(range(4000))[:1200], [], []
    for k, i in enumerate(ids):
        toxic = k % 4 == 0
        words = rng.choices(neutral, k=rng.randint(6, 14))
        if toxic:
            words.insert(2, rng.choice(["scumbags", "vermin", "filth"]) if k % 8 else f"{rng.getrandbits(40):x}")
        if rng.random() < (0.9 if toxic else 0.02):
            words.insert(1, "muslims")
        elif rng.random() < 0.2:
            words.insert(1, rng.choice(["christians", "jews", "hindus"]))
        rows.append((i, " ".join(words) + ".", 1, "clash"))
        labels.append((i, int(toxic), "clash"))
    return rows, labels


def test_swaps_keep_neutral_mentions_clean(spark, biased):
    docs, labels = spark.createDataFrame(biased[0], DOCS), spark.createDataFrame(biased[1], LABELS)
    plain, fair = toxicity.fit(docs, labels, penalty=0.0), toxicity.fit(docs, labels)
    mentions = ["muslims opened the market early.", "many muslims walked home after lunch.", "Muslims and rain over green hills."]
    bad = ["the filth walked home.", "those muslims are vermin over green hills."]
    assert fair.scores(mentions).max() < 0.3 < plain.scores(mentions).max()
    assert fair.scores(mentions).mean() < plain.scores(mentions).mean() / 2 and fair.scores(bad).min() > 0.3
    gap = abs(fair.scores(["muslims walked home."]) - fair.scores(["christians walked home."]))[0]
    assert gap < 0.05 < abs(plain.scores(["muslims walked home."]) - plain.scores(["christians walked home."]))[0]


def test_swapped():
    assert toxicity.swapped("All Muslims, and men!") == "All christians, and girls!"
    assert toxicity.swapped("Nobody's group") is None and toxicity.swapped("") is None
    assert all(a in toxicity.SWAPS for a in toxicity.NAMES)


def test_held_out_accuracy(spark):
    found = queries.op12_toxicity(spark, D).join(spark.read.parquet(f"{D}/labels.parquet"), "doc_id").where("toxic is not null").toPandas()
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in found["doc_id"]]).all()
    held = found[found["held_out"]]
    toxic, said = held["toxic"] == 1, held["predicted"] == 1
    assert (toxic & said).sum() >= 0.93 * toxic.sum() and (~toxic & said).sum() <= 0.005 * (~toxic).sum()
    assert ((held["score"] >= 0) & (held["score"] <= 1)).all()


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark, biased):
    docs = spark.createDataFrame(biased[0], DOCS)
    other = [(i, 1 - t, "x") for i, t, _ in biased[1]]
    held = [(i, 1, "x") for i in range(4000) if zlib.crc32(str(i).encode()) % 4 == 2]
    one = toxicity.fit(docs, spark.createDataFrame(biased[1], LABELS))
    assert one.scores(["the filth"]) == toxicity.fit(docs, spark.createDataFrame(biased[1] + held + [(None, 1, "x")], LABELS)).scores(["the filth"])
    assert one.scores(["the filth"]) != toxicity.fit(docs, spark.createDataFrame(other, LABELS)).scores(["the filth"])


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, None, 0, ""), (2, "", 0, ""), (None, "some words", 0, ""), (4, "word " * 300000, 0, ""), (4, "word " * 300000, 0, "")], DOCS)
    none, one = spark.createDataFrame([], LABELS), spark.createDataFrame([(learnable([1, 2, 4])[0], 1, "")], LABELS)
    for labels, want in ((none, 0.0), (one, 1.0)):
        rows = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
        assert len(rows) == 5 and all(abs(r["score"] - want) < 1e-9 for r in rows)
    assert toxicity.score_documents(spark.createDataFrame([], DOCS), toxicity.constant(0.5)).count() == 0
    assert not [r for r in toxicity.score_documents(docs, toxicity.constant(0.5)).where("doc_id is null").collect() if r["held_out"]]
