"""The pipeline's stages on a small corpus, each against what its operator says of its own input."""

import random
import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
from tests.llm.test_operators import DOCUMENTS, WORDS, clash, prose
from corvane.llm import decontamination, near_duplicates, personal_data, toxicity


def test_stages(spark, tmp_path):
    rng = random.Random(1)
    documents, labels = [], []
    for k in range(400):
        text = prose(k, rng.randint(30, 90))
        toxic = k % 5 == 0
        if toxic:
            text += " vile rotten scummy"
        if k % 7 == 1:
            text += " call +1 (212) 555-0100 or mail bob@ex.org"
        documents.append((k, text, "en", "abc"[k % 3], len(text)))
        labels.append((k, 1, int(toxic)))
    documents += [(500 + k, documents[1][1], "en", "hot", len(documents[1][1])) for k in range(60)]
    item = prose(9000, 30)
    documents += [(600, prose(9001, 20) + " " + item + " " + prose(9002, 20), "en", "a", 0), documents[2]]
    sf = str(tmp_path)
    spark.createDataFrame(documents, DOCUMENTS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{sf}/stage{k}")
        before, docs = docs, spark.read.parquet(f"{sf}/stage{k}")
        kept[name] = [r.doc_id for r in docs.collect()]
        if name != "mixing":
            assert docs.columns == before.columns
        if name == "toxicity":
            scored = toxicity.score_toxicity(before, spark.read.parquet(f"{sf}/labels.parquet"))
            assert sorted(kept[name]) == sorted(r.doc_id for r in scored.where("predicted = 0").collect())
            assert sum(d % 5 == 0 and d < 500 for d in kept[name]) < 8 and sum(d % 5 != 0 for d in kept[name]) > 350
        if name == "near_duplicates":
            groups = {r.component_id for r in near_duplicates.near_duplicates(before).collect()}
            assert sorted(kept[name]) == sorted(groups) and not any(500 <= d < 600 for d in kept[name])
        if name == "decontamination":
            assert 600 not in kept[name]
            found = decontamination.decontaminate(before, spark.read.parquet(f"{sf}/benchmark.parquet"))
            assert sorted(kept[name]) == sorted(r.doc_id for r in found.where("not contaminated").collect())
        if name == "personal_data":
            assert sorted(kept[name]) == sorted(kept["decontamination"])
            assert personal_data.personal_data(docs).where("n_email + n_phone > 0").count() == 0
            assert all(r.n_chars == len(r.text) for r in docs.where("doc_id < 400").collect())
            assert any("<PHONE> or mail <EMAIL>" in r.text for r in docs.collect())
    mixed = docs.toPandas()
    assert sorted(mixed.doc_id) == sorted(kept["personal_data"])
    for _, part in mixed.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= max(5, 0.02 * part.target.iloc[0])
    assert sorted(corpus_pipeline.run(spark, sf).select("doc_id", "taken").collect()) == sorted(tuple(x) for x in mixed[["doc_id", "taken"]].itertuples(index=False))
    assert re.fullmatch(r"\w+", WORDS[0])
    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file:"))
    assert not list(shared.glob("pipeline-*"))  # a run leaves no folder of its own


def test_odd_rows_through_all_stages(spark, tmp_path):
    text = prose(50, 60)
    odd = [
        (None, None, None, None, None), (None, "", "en", None, 0), (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n ", None, "b", 3),
        (4, text, "en", "b", 1), (4, text, "en", "b", 1), (5, text, "en", None, 1), (None, text, "en", "b", 1), (6, prose(51, 20_000), "en", "c", 1),
        (7, "write to a@b.org", "en", "c", 1), (7, prose(52, 40), "en", "c", 1), (8, prose(53, 12), "en", "c", 1),
    ]
    for number, (rows, items) in enumerate([(odd, [(1, prose(53, 12)), (None, None), (2, "")]), ([], []), (odd[:1], [])]):
        sf = str(tmp_path / str(number))
        clash(spark.createDataFrame(rows, DOCUMENTS)).write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, None, None), (None, 1, 1), (4, 0, 0)][: len(rows)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        left = {}
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, sf).write.parquet(f"{sf}/{k}")
            docs, before = spark.read.parquet(f"{sf}/{k}"), docs
            assert name == "mixing" or docs.columns == before.columns
            left[name] = Counter(r.doc_id for r in docs.collect())
        if number == 0:
            assert left["toxicity"].total() == len(rows)  # no toxic label, nothing goes
            assert left["near_duplicates"] == Counter({None: 3, 1: 1, 4: 1, 6: 1, 7: 2, 8: 1})
            assert left["decontamination"] == Counter({None: 3, 1: 1, 4: 1, 6: 1, 7: 2}) == left["personal_data"] == left["mixing"]
        else:
            assert left["mixing"].total() == len(rows)
        assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == left["mixing"]
