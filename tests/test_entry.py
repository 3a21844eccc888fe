"""The driver's contract, and the small registered queries against DuckDB where the test tables are at hand."""

import os

import pytest

import __spark_entry__
from corvane.plans import catalog

FOLDER = "/root/testdata/sf0.001"
SMALL = ("precedence_merge", "bm25_search", "tfidf_related_topk", "interval_overlap_join", "guardrail_citations", "cohens_kappa", "map_diff", "url_parts")


def test_every_oracle_has_a_query():
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and set(catalog.queries()) <= set(queries)
    assert all(callable(f) for f in queries.values()) and all("limit 1000" not in s.lower() for s in oracles.values())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
def test_entry_finds_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", SMALL)
def test_queries_equal_their_oracles(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    found = catalog.queries()[name](spark, FOLDER)
    columns = sorted(found.columns)
    expected = connection.execute(f"SELECT {', '.join(f'{c!r}'.replace(chr(39), chr(34)) for c in columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, expected))
