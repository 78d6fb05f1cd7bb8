import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brute import contamination, similar_groups
from test_linededup import brute as without_boilerplate
from texloom.llm import linededup

D = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        after = corpus_pipeline.written(stage(spark, docs, D), "test")
        got = after.collect()
        if name == "packing":
            check_packed(got, {x[0]: x[1] for x in before})
            break
        assert after.columns == columns
        kept = {r.doc_id: r.text for r in got}
        assert len(kept) == len(got)
        if name == "quality_rules":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
            assert all(t == dict((x[0], x[1]) for x in before)[i] for i, t in kept.items())
            assert sum(labels.get(i) == 0 for i in kept) < sum(labels.get(x[0]) == 0 for x in before) / 2
        elif name == "line_dedup":
            assert kept == dict(without_boilerplate(before, linededup.RATIO, linededup.LEAST_PAGES))
        elif name == "near_dedup":
            assert kept.keys() == set(similar_groups([x[:2] for x in before]).values()) and len(kept) < len(before)
        else:
            bad = contamination([x[1] for x in before], items)
            assert kept.keys() == {x[0] for x, b in zip(before, bad, strict=True) if not b[4]} and len(kept) < len(before)
        docs = after


def check_packed(rows, texts):
    """Each id of each text in one piece, in sequences without holes that are full or a power of two or short."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == texts.keys()
    for doc_id, found in pieces.items():
        ids, at = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], 0
        for start, length, crc, n in sorted(found):
            assert start == at and n == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


EDGES = [(None, None), (None, " ".join(f"u{i}" for i in range(50))), (1, None), (2, ""), (3, " \n\t"), (4, "x"), (4, "x"), (5, " ".join(f"w{i}" for i in range(300_000))), (6, " ".join(f"v{i}" for i in range(60))), (7, " ".join(f"v{i}" for i in range(60))), (8, " ".join(f"V{i}" for i in range(60)) + " end")]


def test_nulls_long_texts_repeated_rows_and_clashing_names(spark):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string").selectExpr("*", "cast(null as string) as lang", "if(doc_id % 2 = 0, 'h', null) as source", "1 as n_chars", "2 as sig", "3 as key", "4 as fp", "5 as quality", "6 as least")
    for name, stage in corpus_pipeline.STAGES:
        found = corpus_pipeline.written(stage(spark, docs, D), "test")
        if name == "packing":
            assert {r.doc_id for r in found.collect()} == {r.doc_id for r in docs.collect()} == {None, 5, 6}
        else:
            assert found.columns == docs.columns
        docs = found


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, D), "test")
    assert docs.count() == 0
