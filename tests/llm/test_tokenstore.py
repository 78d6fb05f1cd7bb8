import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from texloom.llm import tokenstore
from texloom.llm.encoders import Encoder, byte_level_chunks, word_chunks

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("name", "chunks"), [("byte_bpe_50k.json", byte_level_chunks), ("word_bpe_49k.json", word_chunks)])
def test_chunked_encoding_equals_whole_text_encoding(name, chunks):
    enc, rnd = Encoder(public_tokenizers.path(name), chunks), random.Random(1)
    alphabet = " \n\t\r\x1c\x85 ́éÀab'sS1.,\\<|endoftext|>ΣΑσ"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [t + "<|endoftext|>" + t for t in texts[:300]]
    texts += ["plain words, and more. " * 3, "a b", " a", "a ", "", "x  y", "x\n y", "x \ny", "\0a \0b", "a|b | c", "first first"]
    for _ in range(2):
        assert [x.tolist() for x in enc.encode_all(texts)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in enc.encode_all(texts)] == [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenstore.round_trip(df, PATH, "word", 2).collect()}
    t, at, want = Tokenizer.from_file(PATH), 0, {}
    for r in sorted(df.collect(), key=lambda r: r.doc_id):
        ids = t.encode(r.text, add_special_tokens=False).ids + [2]
        want[r.doc_id] = at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert got == want


def test_edges(spark):
    df = spark.createDataFrame([(3, None), (None, "x y"), (1, ""), (3, "b"), (3, "b"), (-5, "w " * 5000)], "doc_id bigint, text string").selectExpr("*", "1 as start", "2 as shard")
    rows = sorted(tokenstore.round_trip(df, PATH, "word", 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, -5, 1, 3, 3, 3] and [r.n_tokens for r in rows] == [3, 5001, 1, *sorted([1, 2, 2], key=lambda n: [r.n_tokens for r in rows[3:]].index(n))]
    assert [b.start - a.start for a, b in zip(rows, rows[1:], strict=False)] == [r.n_tokens for r in rows[:-1]]
    assert tokenstore.round_trip(df.where("false"), PATH, "word", 2).count() == 0


def test_one_document_is_read_alone():
    rng = np.random.default_rng(0)
    arrays = [rng.integers(0, 500, n).astype("<u2") for n in (0, 1, 900, 5, *[300] * 2000)]
    dictionary = tokenstore.trained([a.tobytes() for a in arrays], 4096)
    assert dictionary
    out = io.BytesIO()
    writer = tokenstore.Writer(out, dictionary, np.dtype("<u2"))
    for i, a in enumerate(arrays):
        writer.add(i if i else None, a)
    writer.finish()

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = tokenstore.Reader(File(out.getvalue()), dictionary)
    assert reader.ids[:3] == [None, 1, 2] and all((reader.get(k) == arrays[k]).all() for k in (3, 0, 2, 1500))
    with pytest.raises(ValueError):
        tokenstore.Reader(File(out.getvalue()), b"other")


def test_names_of_other_types(spark):
    rows = [("é b", "x y"), (None, "z"), ("", "w"), ("a" * 300, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted(tokenstore.round_trip(df, PATH, "word", 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, "", "a" * 300, "é b"] and [r.n_tokens for r in got] == [2, 2, 1, 3]
    days = spark.sql("select date'2020-01-02' as doc_id, 'x' as text union all select date'2019-01-02', 'y'")
    found = tokenstore.round_trip(days, PATH, "word", 2)
    assert [str(r.doc_id) for r in found.orderBy("start").collect()] == ["2019-01-02", "2020-01-02"] and found.schema["doc_id"].dataType == days.schema["doc_id"].dataType
    assert tokenstore.round_trip(days.where("false"), PATH, "word", 2).schema["doc_id"].dataType == days.schema["doc_id"].dataType
    assert [r.doc_id for r in tokenstore.round_trip(spark.sql("select cast(5 as int) as doc_id, 'x' as text"), PATH, "word", 2).collect()] == [5]
