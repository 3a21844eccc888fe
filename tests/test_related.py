"""The bounded search for related records against all pairs."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvane.operators import similarity

WEIGHT = {"cwe": 3.0, "path": 1.0, "fn": 3.0, "kg": 1.0}


def records(count: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for key in range(count):
        features = {f"cwe:{draw.choice([1, 1, 1, 2, 3, 4, 5])}", f"path:{draw.randint(0, 25)}"} | {f"fn:{int(draw.paretovariate(0.6)) % 97}" for _ in range(draw.randint(0, 4))}
        features |= {f"kg:{draw.randint(0, count)}" for _ in range(draw.randint(0, 3))}
        rows += [(key, f, WEIGHT[f.split(":")[0]]) for f in features]
        if key % 9 == 0:  # the same record several times
            rows += [(count + 10 * key + n, f, WEIGHT[f.split(":")[0]]) for n in range(key % 7) for f in features]
    return rows


def all_pairs(rows, asked, k, cut, min_keys):
    df, keys = Counter(f for _, f, _ in rows), {r[0] for r in rows}
    vectors = defaultdict(dict)
    for key, f, weight in rows:
        w = weight * math.log(len(keys) / df[f])
        if w > 0:
            vectors[key][f] = w
    length = {key: math.sqrt(sum(w * w for w in v.values())) for key, v in vectors.items()}
    short = {key: {f: math.floor(w * 10000 + 0.5) / 10000 for f, w in v.items()} for key, v in vectors.items()}
    selective = {f for f in df if len(keys) < min_keys or df[f] <= cut * len(keys)}
    found = []
    for q in filter(asked, short):
        scored = []
        for o, v in short.items():
            both = v.keys() & short[q].keys()
            if o != q and both & selective:
                dot = sum(v[f] * short[q][f] for f in sorted(both))
                scored.append((-math.floor(dot / (length[q] * length[o]) * 10000 + 0.5), o))
        found += [(q, o, -s, r) for r, (s, o) in enumerate(sorted(x for x in scored if x[0] < 0)[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize(("seed", "k", "cut"), [(1, 10, 0.05), (2, 3, 0.02), (3, 5, 0.5)])
def test_related_equals_all_pairs(spark, monkeypatch, seed, k, cut):
    monkeypatch.setattr(similarity, "PROBES", 3)
    monkeypatch.setattr(similarity, "HEAVIEST", 2)
    rows = records(220, seed)
    frame = spark.createDataFrame(rows, "key long, feature string, weight double").repartition(3)
    got = sorted(map(tuple, similarity.related(frame, F.col("key") % 3 == 0, k, cut).collect()))
    expected = all_pairs(rows, lambda key: key % 3 == 0, k, cut, 40)
    off = [(a, b) for a, b in zip(got, expected, strict=True) if a != b and not (a[0] == b[0] and abs(a[2] - b[2]) <= 1)]
    assert not off  # sums in another order may differ by one in the last place


def test_bounds_drop_pairs_that_cannot_be_among_the_best(spark):
    rows = records(600, 7)
    frame = spark.createDataFrame(rows, "key long, feature string, weight double")
    vectors = similarity.weighted(frame, similarity.inverse_frequencies(frame)).cache()
    asked = vectors.where("key % 20 = 0")
    selective = F.col("df") <= 0.05 * F.col("n")
    bounded = similarity.candidates(vectors, asked, selective, 3).count()
    left, right = (v.where(selective).select(F.col("key").alias(c), "feature") for v, c in ((asked, "a"), (vectors, "b")))
    assert bounded < 0.6 * left.join(right, "feature").where("a <> b").select("a", "b").distinct().count()
    vectors.unpersist()


def test_no_features_and_lone_keys(spark):
    frame = spark.createDataFrame([], "key long, feature string, weight double")
    assert similarity.related(frame, F.col("key") % 2 == 0).count() == 0
    frame = spark.createDataFrame([(1, "a", 1.0), (2, "b", 1.0)], "key long, feature string, weight double")
    assert similarity.related(frame, F.lit(True)).count() == 0
