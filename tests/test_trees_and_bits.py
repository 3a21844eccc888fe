"""Hash trees of stored tables, and walks of many roots at once."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from corvane.operators import graph, hashtree

SCHEMA = "k long, a string, b int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_trees_find_the_rows_that_differ(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(k, f"x{k % 7}", None if k % 5 == 0 else k) for k in range(300)] + [(1, "", 1), (1, None, 1), (9, "x2", 9), (None, None, None)]
    hashtree.store(table(spark, rows), ["k"], path)
    assert Counter(map(tuple, hashtree.stored_rows(spark, path).collect())) == Counter(rows)
    assert hashtree.drift(table(spark, rows[::-1]), ["k"], path).count() == 0
    changed = [r for r in rows if r[0] != 17] + [(17, "new", 17), (9, "x2", 9), (1000, "more", 0)]
    found = Counter(map(tuple, hashtree.drift(table(spark, changed), ["k"], path).select("side", *SCHEMA.split(", ")[0].split()[:1], "a", "b").collect()))
    assert found == Counter([("extra", 17, "x3", 17), ("missing", 17, "new", 17), ("missing", 9, "x2", 9), ("missing", 1000, "more", 0)])
    fresh = hashtree.tree_of(hashtree.leaves(table(spark, changed), ["k"]))
    leaves = hashtree.differing(fresh, spark.read.parquet(f"{path}/tree"))
    assert len(leaves) == 3 and hashtree.stored_rows(spark, path, leaves).count() < 10  # rows that a comparison reads
    assert hashtree.update(table(spark, changed), ["k"], path) == len({x[:2] for x in leaves})
    assert hashtree.drift(table(spark, changed), ["k"], path).count() == 0 and hashtree.update(table(spark, changed), ["k"], path) == 0
    few = changed[:3]
    hashtree.update(table(spark, few), ["k"], path)
    assert Counter(map(tuple, hashtree.stored_rows(spark, path).collect())) == Counter(few)


def test_walks_of_many_roots_equal_single_ones(spark):
    draw = random.Random(4)
    edges = [(f"n{draw.randint(0, 90)}", f"n{draw.randint(0, 90)}") for _ in range(150)] + [("a", "a"), ("a", "b"), ("b", "a")]
    near = defaultdict(set)
    for s, t in edges:
        near[s].add(t)
        near[t].add(s)
    roots = [f"n{k}" for k in range(0, 91, 1)] + ["a", "lone", "a"]
    want = set()
    for root in roots:
        seen, edge = {root}, {root}
        want.add((root, root, 0))
        for hop in (1, 2, 3):
            edge = {t for n in edge for t in near[n]} - seen
            seen |= edge
            want |= {(root, n, hop) for n in edge}
    seeds, arcs = spark.createDataFrame([(r,) for r in roots], "node string"), spark.createDataFrame(edges, "source string, target string")
    got = graph.reach(seeds, arcs, 3).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    numbered = graph.numbered_roots(seeds).cache()
    assert numbered.select("part", "bit").distinct().count() == numbered.count() == len(set(roots)) and numbered.agg(F.max("bit")).first()[0] < 64
    counts = {tuple(r) for r in graph.reach_counts(numbered, graph.reach_bits(numbered, arcs, 2)).collect()}
    assert counts == {(r, h, n) for (r, h), n in Counter((r, h) for r, _, h in want if h < 3).items()}
    numbered.unpersist()
