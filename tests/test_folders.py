"""Exports that count only when committed, and archives that are streamed."""

import io
import json
import os
import tarfile
import time

import pytest
from pyspark.sql import functions as F

from texloom.operators import export
from texloom.sources import files, folders


@pytest.fixture(scope="module", autouse=True)
def sources(spark):
    folders.register(spark)


def manifests(folder):
    at = os.path.join(folder, folders.MANIFESTS)
    return [f for f in os.listdir(at) if f.endswith(".json")] if os.path.isdir(at) else []


def test_files_and_a_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(f"a/{k}/x.json", f"{{{k}}}".encode()) for k in range(30)] + [("empty.txt", None)], "path string, content binary").repartition(4)
    rows.write.format("paper_folder").mode("append").save(str(tmp_path))
    assert len(manifests(tmp_path)) == 1 and (tmp_path / "a/7/x.json").read_bytes() == b"{7}" and (tmp_path / "empty.txt").read_bytes() == b""
    assert sorted(r[0] for r in folders.committed(spark, str(tmp_path)).collect()) == sorted(["empty.txt", *(f"a/{k}/x.json" for k in range(30))])
    assert not [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".part")]


def test_a_failing_task_leaves_no_manifest(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.lit("p/"), F.col("id").cast("string")).alias("path"), F.when(F.col("id") == 33, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).cast("binary").alias("content")).repartition(4, "path")
    with pytest.raises(Exception):
        rows.write.format("paper_folder").mode("append").save(str(tmp_path))
    assert manifests(tmp_path) == [] and folders.committed(spark, str(tmp_path)).isEmpty()
    fine = rows.where("path <> 'p/33'")
    fine.write.format("paper_folder").mode("append").save(str(tmp_path))
    assert folders.committed(spark, str(tmp_path)).count() == 39 and (tmp_path / "p/1").read_bytes() == b"x"


def test_overwriting_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="appends"):
        spark.createDataFrame([("a", b"b")], "path string, content binary").write.format("paper_folder").mode("overwrite").save(str(tmp_path))


def test_export_of_successful_papers(spark, tmp_path):
    listed = tmp_path / "done.csv"
    listed.write_text("path,status\n/data/cs/p1,success\n/data/cs/p2,failed\n/data/math/p3/,success\n/data/math/p3/,success\n/data/math/p9,success\n")
    statuses = files.manifest(spark, str(listed))
    ids = spark.createDataFrame([("/data/cs/p1", 1), ("/data/cs/p2", 2), ("/data/math/p3/", 3)], "path string, doc_id bigint")
    documents = {"report": spark.createDataFrame([(k, f'{{"n": {k}}}') for k in (1, 2, 3)], "doc_id bigint, report string"), "texts": spark.createDataFrame([(1, {"Title": ["T"]}), (3, None)], "doc_id bigint, texts map<string,array<string>>")}
    images = spark.createDataFrame([(1, 0, b"img"), (3, 11, b"eleven")], "doc_id bigint, page_index int, content binary")
    out = str(tmp_path / "set")
    assert export.export_papers(statuses, ids, documents, out, images) == 2
    names = sorted(os.path.relpath(os.path.join(d, f), out) for d, _, fs in os.walk(out) for f in fs if folders.MANIFESTS not in d)
    assert names == ["cs/p1/original-page-0000.jpg", "cs/p1/quality_report.json", "cs/p1/texts.json", "math/p3/original-page-0011.jpg", "math/p3/quality_report.json"]
    assert json.loads((tmp_path / "set/cs/p1/texts.json").read_text()) == {"Title": ["T"]}
    changed = {"report": documents["report"].withColumn("report", F.lit("new"))}
    assert export.export_papers(statuses, ids, changed, out) == 0 and json.loads((tmp_path / "set/cs/p1/quality_report.json").read_text()) == {"n": 1}
    more = statuses.union(spark.createDataFrame([("/data/cs/p2", "success")], "path string, status string"))
    assert export.export_papers(more, ids, changed, out) == 1 and (tmp_path / "set/cs/p2/quality_report.json").read_text() == "new"


def archive(path, members, cut=None):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        for name, content in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            tar.addfile(info, io.BytesIO(content))
    path.write_bytes(buffer.getvalue()[:cut])


def test_archives_beyond_the_cell_limit(spark, tmp_path):
    big = {f"m{k}.tex": os.urandom(20_000) for k in range(10)}
    archive(tmp_path / "big.tar.gz", big)
    (tmp_path / "sub").mkdir()
    archive(tmp_path / "sub/small.tar.gz", {"a/main.tex": b"\\begin{document}", "empty": b""})
    archive(tmp_path / "cut.tar.gz", big, 60_000)
    (tmp_path / "none.tar.gz").write_bytes(b"no archive")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100000")
    try:
        with pytest.raises(Exception):
            files.files(spark, str(tmp_path), ".tar.gz").select("content").collect()
        rows = spark.read.format("archive_members").load(str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r["path"]), []).append(r)
    assert {r["member"]: bytes(r["content"]) for r in by["big.tar.gz"]} == big
    assert sorted((r["member"], bytes(r["content"])) for r in by["small.tar.gz"]) == [("a/main.tex", b"\\begin{document}"), ("empty", b"")]
    assert [r["error"] is not None for r in by["cut.tar.gz"]][-1] and len(by["cut.tar.gz"]) > 1 and len(by["none.tar.gz"]) == 1 and by["none.tar.gz"][0]["error"]


def test_new_archives_once(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def run():
        q = spark.readStream.format("archive_members").load(str(source)).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted(r[0] for r in spark.read.schema("path string, member string, content binary, error string").parquet(out).select("member").collect())

    archive(source / "a.tar.gz", {"one": b"1"})
    archive(source / "b.tar.gz", {"two": b"2"})
    stamp = time.time() - 100
    os.utime(source / "a.tar.gz", (stamp, stamp))
    os.utime(source / "b.tar.gz", (stamp, stamp))
    assert run() == ["one", "two"] and run() == ["one", "two"]
    archive(source / "c.tar.gz", {"three": b"3"})
    os.utime(source / "c.tar.gz", (stamp, stamp))  # as old as those that were read
    assert run() == ["one", "three", "two"]
    archive(source / "d.tar.gz", {"four": b"4"})
    assert run() == ["four", "one", "three", "two"]


def test_json_datasets_append_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "cs", "x"), (2, "math", "y")], "doc_id bigint, discipline string, v string")
    path = str(tmp_path / "j")
    export.json_documents(rows, path, ["discipline", "doc_id"])
    export.json_documents(rows.union(spark.createDataFrame([(3, "cs", "z")], rows.schema)), path, ["discipline", "doc_id"])
    found = files.json_documents(spark, path, "doc_id bigint, discipline string, v string")
    assert sorted((r["doc_id"], r["discipline"], r["v"]) for r in found.collect()) == [(1, "cs", "x"), (2, "math", "y"), (3, "cs", "z")]
