from brute import ASCII_WORD, lower_ascii
from texloom.llm import licenses


def brute(text):
    words = ASCII_WORD.findall(lower_ascii(text or ""))
    n, places, base, labels, best = len(words), [], set(), set(), 0.0
    for phrase, label in licenses.PHRASES:
        k = phrase.split()
        found = [i for i in range(n) if words[i : i + len(k)] == k]
        places += found
        if found:
            base.add(label)
    for label, template, keys in licenses.TEMPLATES:
        t = template.split()
        must = licenses.key_places(template, keys)
        at = lambda i: words[i] if 0 <= i < n else None
        for s in range(-len(t), n):
            if all(at(s + j) == w for j, w in must):
                score = sum(at(s + j) == w for j, w in enumerate(t)) / len(t)
                if score >= licenses.LEAST_SCORE:
                    labels.add(label)
                    best = max(best, score)
    return n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if base else best


TEXTS = [None, "", "MIT license", "the MIT-License; mit license", "commit license mit licensex", "apache\nlicense general public  license", "Kİ mİt license K", "É Licensed under CC BY-NC 4.0.", "general public general public license", "license"]
TEXTS += [t for _, t, _ in licenses.TEMPLATES] + [" ".join(t.split()[2:]) + " x" for _, t, _ in licenses.TEMPLATES] + [("word " * 3000) + licenses.TEMPLATES[0][1].upper() + " mit license" * 500]
TEXTS += [licenses.TEMPLATES[7][1].replace("conditions", "terms").replace("permitted", "ok"), licenses.TEMPLATES[7][1].replace("binary", "other")]


def test_equals_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").selectExpr("*", "1 as n_words", "2 as labels")
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(TEXTS))] == [brute(t) for t in TEXTS]


def test_native_plan_and_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert licenses.scan(df).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(table)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))
