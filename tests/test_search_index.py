"""The stored inverted index against the scan that knows no index."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.operators import search, text_index

WORDS = ["alpha", "beta", "gamma", "delta", "rare", "überall", "x1", "the", "of"]


def corpus(count: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    weights = [3, 3, 2, 1, 0.05, 0.5, 1, 20, 10]
    rows = [(k, " ".join(draw.choices(WORDS, weights, k=draw.randint(0, 40))) + draw.choice(["", ".", " Alpha_beta"])) for k in range(count)]
    return [*rows, (count, None), (3, "the alpha beta rare"), (None, "rare delta")]


def same(found, expected):
    found, expected = [tuple(r) for r in found.collect()], [tuple(r) for r in expected.collect()]
    assert [(k, t) for k, _, t in found] == [(k, t) for k, _, t in expected]
    assert all(abs(a[1] - b[1]) < 1e-9 for a, b in zip(found, expected, strict=True))


@pytest.mark.parametrize("segment", [1500, 4_000_000])
def test_index_answers_like_the_scan(spark, tmp_path, monkeypatch, segment):
    monkeypatch.setattr(text_index, "BLOCK", 4)
    docs = spark.createDataFrame(corpus(250, segment), "doc_id long, text string").repartition(3)
    path = str(tmp_path / "index")
    sized = lambda batches: _with(batches, segment)  # noqa: E731  workers import the module anew
    monkeypatch.setattr(text_index, "_segments", sized)
    text_index.upsert(docs, "doc_id", "text", path)
    index = text_index.TextIndex(spark, path)
    asked = [("alpha beta", 5, 2, -5.0), ("rare", 40, 2, -1.0), ("the_of_the delta", 40, 1, -5.0), ("the_the of", 5, 2, -5.0), ("überall x1 zzz", 5, 1, -5.0), ("zzz", 5, 1, -5.0), (" ! ", 5, 1, -5.0)]
    for query, limit, terms, cut in asked:
        same(index.search(query, limit, cut, terms, key="doc_id"), search.bm25(docs, query, "doc_id", "text", limit, cut, terms))


def _with(batches, segment):
    text_index.SEGMENT = segment
    waiting, size = [], 0
    import pyarrow as pa

    for batch in batches:
        for k in range(batch.num_rows):
            waiting.append(pa.Table.from_batches([batch.slice(k, 1)]))
            size += len(batch.column("tokens")[k].as_py() or [])
            if size >= segment:
                yield from text_index._segment(waiting)
                waiting, size = [], 0
    if waiting:
        yield from text_index._segment(waiting)


def test_slices_are_replaced_and_searched_together(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = corpus(120, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for part in range(3):
        text_index.upsert(docs.where(F.coalesce("doc_id", F.lit(0)) % 3 == part), "doc_id", "text", path, f"p{part}")
    changed = docs.where(F.coalesce("doc_id", F.lit(0)) % 3 == 1).withColumn("text", F.concat_ws(" ", "text", F.lit("rare rare"))).where("doc_id < 90")
    text_index.upsert(changed, "doc_id", "text", path, "p1")
    now = docs.where(F.coalesce("doc_id", F.lit(0)) % 3 != 1).unionByName(changed)
    same(text_index.TextIndex(spark, path).search("rare alpha", 30, key="doc_id"), search.bm25(now, "rare alpha", "doc_id", "text", 30))


def test_named_identifiers_are_answered_by_their_records_only(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [("lin-CVE-2020-10", "buffer overflow CVE-2020-1"), ("cve-2020-1-fix", "nothing"), ("b CVE-2020-1 CVE-2021-2222", "buffer"), ("plain", "CVE-2020-1 buffer overflow")]
    text_index.upsert(spark.createDataFrame(rows, "id string, text string"), "id", "text", path)
    index = text_index.TextIndex(spark, path)
    ask = lambda q, n=5: [tuple(r) for r in index.search(q, n, key="id", identifier=text_index.IDENTIFIER).collect()]
    assert ask("CVE-2020-1 buffer overflow") == [("b CVE-2020-1 CVE-2021-2222", 0.0, 1), ("cve-2020-1-fix", 0.0, 1)]
    assert ask("cve-2020-1 and CVE-2021-2222", 1) == [("b CVE-2020-1 CVE-2021-2222", 0.0, 2)]
    assert ask("CVE-2099-1 buffer overflow") == []
    assert [r[0] for r in ask("buffer overflow")] == ["lin-CVE-2020-10", "plain"]


def test_search_reads_its_own_postings_only(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(k, f"word{k} word{k % 50} common") for k in range(4000)]
    text_index.upsert(spark.createDataFrame(rows, "id long, text string").coalesce(1), "id", "text", path)
    index = text_index.TextIndex(spark, path)
    assert [tuple(r)[:3] for r in index.matches("word7 word3999").orderBy("term").collect()] == [("word3999", 1, 1), ("word7", 1, 80)]
    plan = index.postings([["word7"]])._jdf.queryExecution().executedPlan().toString()
    assert "In(term, [word7])" in plan or "EqualTo(term,word7)" in plan
    assert "positions" not in plan.split("ReadSchema")[1]


def test_blocks_below_the_threshold_are_not_scored():
    rows = np.arange(20_000)
    counts = np.where(rows < 200, 9, 1)
    blocks = np.arange(0, len(rows), text_index.BLOCK)
    lists = [(rows, counts, np.full(len(rows), 50), np.maximum.reduceat(counts, blocks), np.full(len(blocks), 50))]
    best, scored = text_index.best_rows(lists, [0.4], 50.0, 10, 0.0, 1)
    assert [row for _, _, row in best] == list(range(10)) and scored <= 2 * text_index.BLOCK


def test_an_empty_table_answers_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    text_index.upsert(spark.createDataFrame([(1, None)], "id long, text string"), "id", "text", path)
    assert text_index.TextIndex(spark, path).search("a b", key="id").count() == 0
    text_index.upsert(spark.createDataFrame([], "id long, text string"), "id", "text", f"{path}-none")
    assert text_index.TextIndex(spark, f"{path}-none").search("a b", key="id").count() == 0
