import duckdb
import pytest

import __spark_entry__ as entry
from texloom.plans import oracles, queries

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if hasattr(v, "asDict"):
        return [plain(x) for x in v]
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, D)
    want = duck.sql(oracles.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert queries.QUERIES[name](spark, D).count() > 0


def test_entry_and_registry(spark):
    assert entry.entry(spark).columns == ["doc_id", "type", "from_id", "to_id"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
