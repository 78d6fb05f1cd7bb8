import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from texloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts):
    t = Tokenizer.from_file(PATH)
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [0] for i, x in texts.items()}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert by_doc.keys() == want.keys()
    for i, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0
            at += r.length
        assert at == len(want[i])
    pad = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        pad += 0 if at & (at - 1) == 0 else 1024 - at
    return pad, len(by_seq)


def test_whole_table_has_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    pad, n = check(packing.pack(df, PATH).collect(), texts)
    assert pad <= 1024 * 4 and n > 10


def test_edges(spark):
    texts = {1: None, 2: "", 3: "x" * 9000, 4: "same words", 5: "same words", 6: " <|endoftext|>\n\n a b  c"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").selectExpr("*", "1 as offset", "2 as start")
    check(packing.pack(df, PATH).collect(), texts)
    assert packing.pack(df.where("false"), PATH).count() == 0
    twice = packing.pack(df.where("doc_id = 4").union(df.where("doc_id = 4")), PATH).collect()
    assert Counter(r.doc_id for r in twice) == {4: 2}


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 50, rng.integers(5, 40)) for _ in range(30)]
    having = np.bincount(np.concatenate([np.unique(p) for p in parts]), minlength=50)
    idf = np.log1p((30 - having + 0.5) / (having + 0.5)).astype(np.float32)
    usual = float(np.mean([len(p) for p in parts]))
    index = packing.Index(parts, idf, usual)

    def weight(p, t):
        tf = int((p == t).sum())
        return idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(p) / usual))

    for k in range(30):
        asked = index.asked(k)
        assert len(set(asked)) == len(asked) <= packing.QUERY
        unused = np.ones(30, bool)
        unused[k] = False
        scores = {j: sum(weight(parts[j], t) for t in asked) for j in range(30) if j != k}
        found = index.neighbours(k, unused)
        assert np.allclose([scores[j] for j in found], sorted((s for s in scores.values() if s > 0), reverse=True), rtol=1e-4)


def test_neighbours_are_fetched_until_the_window_is_full():
    parts = [np.arange(5) + 10 * (k % 2) for k in range(600)]
    idf = np.full(100, 0.7, np.float32)
    mixed = [s for s in packing.pack_shard(parts, idf, 5.0) if len({k % 2 for k, _, _ in s}) > 1]
    assert len(mixed) <= 1  # where the first group ends


def test_all_ids_of_a_seed_count():
    few, last = np.arange(30), np.array([29] * 10)
    parts = [few, np.arange(100, 110), last, np.arange(100, 110), *([np.arange(29)] * 3)]
    idf = np.full(200, 2.0, np.float32)
    idf[29] = 0.1
    first = next(packing.pack_shard(parts, idf, 10.0, 30 + 3 * 29 + 10))
    assert {k for k, _, _ in first} == {0, 2, 4, 5, 6}
