import base64
import hashlib

from texloom.llm import warc
from texloom.llm.files import open_file


def want(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        other = first.get(html or "") if i is not None and i != first[html or ""] else None
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if other is None else "revisit", other))
    return sorted(out, key=str)


def test_round_trip_with_edges(spark):
    rows = [(i, f"http://h/{i} x\r\n", f"<p>page {i % 7} é {'x' * (i % 7) * 100}</p>\r\n\r\nWARC/1.1") for i in range(60)]
    rows += [(100, None, None), (99, "", ""), (None, "u", ""), (None, "u", "only here"), (101, "u", "big" * 400_000), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as _key", "2 as records")
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == want(rows)
    assert warc.round_trip(df.where("false")).count() == 0


def test_archives_carry_their_dictionary_and_payloads(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    folder = warc.write_archives(df)
    pages = {str(r.page_id): r.html for r in df.collect()}
    seen = 0
    for r in spark.read.parquet(f"{folder}/manifest").collect():
        with open_file(r.uri) as f:
            head = f.read(8)
            assert head[:4] == b"\x5d\x2a\x4d\x18" and int.from_bytes(head[4:], "little") > 1000
            f.seek(0)
            for h, _, payload in warc.read_archive(f):
                seen += 1
                if h["WARC-Type"] == "response":
                    assert payload.decode() == pages[h["WARC-Record-ID"][10:-1].split(":")[0]]
    assert seen == len(pages)


def test_record_ids_are_unique_and_references_hold(spark):
    rows = [(k % 5, "u", f"text {k % 3}") for k in range(60)] + [(None, None, "text 0")] * 3 + [(7, None, "alone")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    for limit in (1 << 20, -1):
        warc.BROADCAST_BYTES, before = limit, warc.BROADCAST_BYTES
        try:
            folder = warc.write_archives(df)
        finally:
            warc.BROADCAST_BYTES = before
        heads = []
        for r in spark.read.parquet(f"{folder}/manifest").collect():
            with open_file(r.uri) as f:
                heads += [h for h, _, _ in warc.read_archive(f)]
        ids = [h["WARC-Record-ID"] for h in heads]
        responses = {h["WARC-Record-ID"]: h["WARC-Payload-Digest"] for h in heads if h["WARC-Type"] == "response"}
        assert len(set(ids)) == len(ids) == len(rows)
        assert all(responses[h["WARC-Refers-To"]] == h["WARC-Payload-Digest"] for h in heads if h["WARC-Type"] == "revisit")
        kind = df.schema["page_id"].dataType
        got = warc.read_archives(spark, folder)
        assert sorted([(r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in got.collect()], key=str) == want(rows), kind


def test_small_archives_have_a_dictionary_of_their_size():
    import io
    out = io.BytesIO()
    rows = [warc.record(k, f"http://h/{k}", b"<html><body>the same words on each page, number %d</body></html>" % k, None) for k in range(40)]
    warc.write_archive(out, iter(rows))
    size = int.from_bytes(out.getvalue()[4:8], "little")
    assert 256 <= size <= sum(map(len, rows)) // 8 and len(out.getvalue()) < sum(map(len, rows)) / 2
    out.seek(0)
    assert [int(h["WARC-Record-ID"][10:-1].split(":")[0]) for h, _, _ in warc.read_archive(out)] == list(range(40))


def test_empty_ids_are_not_null_ones(spark):
    df = spark.createDataFrame([("", "u", "a"), ("b", "u", "a"), (None, "u", "a"), ("c:d/", None, "x")], "page_id string, url string, html string")
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(df).collect()), key=str)
    assert got == sorted([("", "response", None), ("b", "revisit", ""), (None, "response", None), ("c:d/", "response", None)], key=str)
