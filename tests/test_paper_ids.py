"""Paper ids that repeat in large tables."""

from texloom.operators import records
from texloom.plans import queries
from texloom.schema import SEARCH_RESULTS


def test_ids_that_repeat_stay_apart_within_a_collection(spark):
    columns = [c.split()[0] for c in SEARCH_RESULTS.split(", ")]
    rows = [(c, *(f"http://papers.example/abs/2301.10000v{v}" if k == "entry_id" else f"{c}-{v}" if k == "title" else None for k in columns)) for c in (10_000, 100_000) for v in (2, 10)]
    paths = spark.createDataFrame([(100_000, "2301.10000", "/p")], "doc_id bigint, paper_id string, paper_path string")
    entries = spark.createDataFrame(rows, f"doc_id bigint, {SEARCH_RESULTS}")
    found = records.paper_records(entries, paths, within=["doc_id"])
    assert sorted((r["doc_id"], r["title"], r["paper_path"]) for r in found.collect()) == [(10_000, "10000-10", None), (100_000, "100000-10", "/p")]
    assert records.paper_records(entries.drop("doc_id")).count() == 1


def test_paper_records_of_six_digit_documents(spark, tmp_path):
    rows = [(i, f"t {i}", "en", "web", 3) for i in (10_000, 100_000, 100_001, 99_999)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.q39_paper_records(spark, str(tmp_path)).count() == 4
