"""Substring and all-tokens search through the stored index, against the scans."""

import random

from corvane.operators import gram_index, search


def test_index_answers_like_the_scans(spark, tmp_path):
    draw = random.Random(6)
    rows = [(k if k % 50 else None, draw.choice(["Aa", None, "bß"]), "".join(draw.choices("ab Cä𝔘_", k=draw.randint(0, 30))) or None) for k in range(400)]
    frame = spark.createDataFrame([*rows, (7, "Aa", "needle in HAY")], "id long, kind string, text string").repartition(3)
    index = gram_index.GramIndex.build(frame, "id", ("kind", "text"), str(tmp_path / "index"))
    keys = lambda found: [r.id for r in found.collect()]
    for text, limit in (("needle", -1), ("aa ab", 5), ("ab ", -1), ("b", 9), ("𝔘ä", -1), ("nowhere", 3), ("aa needle in hay", 1), ("ß ", -1)):
        scan = frame.where(search.haystack("kind", "text").contains(text.lower())).orderBy("id")
        assert keys(index.search([text.lower()], "id", limit)) == keys(scan if limit < 0 else scan.limit(limit))
    for tokens in ("ab cä", "a b", "need hay", "aa abc zzz"):
        assert keys(index.search(tokens.split(), "id", 200)) == keys(search.token_search(frame, tokens, ("kind", "text"), "id"))
    assert index.candidates(["needle"]).count() == 1 and index.candidates(["ab"]) is None


def test_empty_tables(spark, tmp_path):
    index = gram_index.GramIndex.build(spark.createDataFrame([(1, None)], "id long, text string"), "id", ("text",), str(tmp_path / "one"))
    assert index.search(["abc"], "id").count() == 0
    nothing = gram_index.GramIndex.build(spark.createDataFrame([], "id long, text string"), "id", ("text",), str(tmp_path / "none"))
    assert nothing.search(["abc"], "id").count() == 0 and nothing.search(["a"], "id").count() == 0
