from texloom import fixtures

D = "/root/testdata/sf0.001"


def test_more_docs_hold_whole_texts(spark):
    texts = {r.doc_id: r.text for r in fixtures.documents(spark, D).collect()}
    found = {r.doc_id: r.tex for r in fixtures.more_docs(spark, D).collect()}
    assert found.keys() == texts.keys() and all(texts[i] in t for i, t in found.items())
