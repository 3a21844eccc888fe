"""Queries of the similarity family: TF-IDF, dense vectors, MinHash, count maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import vectors as V
from corvane.functions.scores import scaled
from corvane.operators import matching, similarity
from corvane.operators.search import word_tokens
from corvane.plans.registry import query
from corvane.session import checkpointed
from corvane.sources.tables import table

_TOKENS = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


@query(f"""
WITH f AS (SELECT DISTINCT doc_id, unnest({_TOKENS}) AS feature FROM documents),
n AS (SELECT count(DISTINCT doc_id) AS n FROM f)
SELECT feature, count(*) AS df, CAST(floor(ln(CAST(any_value(n) AS DOUBLE) / count(*)) * 10000 + 0.5) AS BIGINT) AS idf
FROM f, n GROUP BY feature
""")
def df_idf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")  # one row per id
    total = documents.agg(F.count_if(F.col("text").rlike(r"[\p{L}\p{N}]")).alias("n"))
    features = documents.select(F.col("doc_id").alias("key"), F.explode(F.array_distinct(word_tokens(F.col("text")))).alias("feature"))
    return similarity.inverse_frequencies(features, total).select("feature", "df", scaled(F.col("idf")).alias("idf"))


def _part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = lambda kind, column, weight: F.struct(
        F.concat(F.lit(kind + ":"), F.col(column).cast("string")).alias("feature"), F.lit(float(weight)).alias("weight")
    )
    kinds = F.array(feature("brand", "p_brand", 3), feature("type", "p_type", 2), feature("size", "p_size", 1))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.inline(kinds))


_VECTORS = """
f AS (
  SELECT p_partkey AS key, 'brand:' || p_brand AS feature, CAST(3 AS DOUBLE) AS weight FROM part
  UNION ALL SELECT p_partkey, 'type:' || p_type, CAST(2 AS DOUBLE) FROM part
  UNION ALL SELECT p_partkey, 'size:' || CAST(p_size AS VARCHAR), CAST(1 AS DOUBLE) FROM part),
n AS (SELECT count(DISTINCT key) AS n FROM f),
d AS (SELECT feature, count(DISTINCT key) AS df FROM f GROUP BY feature),
r AS (SELECT key, f.feature, weight * ln(CAST(n AS DOUBLE) / df) AS w, df, n FROM f JOIN d USING (feature), n),
l AS (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY key)) AS length FROM r WHERE w > 0),
v AS (SELECT key, feature, floor(w * 10000 + 0.5) / 10000 AS w, length, df, n FROM l)"""


@query(f"""
WITH {_VECTORS},
p AS (SELECT DISTINCT a.key, b.key AS other FROM v a JOIN v b ON a.feature = b.feature AND a.key <> b.key
  WHERE a.key % 100 = 0 AND (a.n < 40 OR a.df <= 0.05 * a.n)),
s AS (SELECT p.key, p.other, CAST(floor(sum(a.w * b.w) / (any_value(a.length) * any_value(b.length)) * 10000 + 0.5) AS BIGINT) AS score
  FROM p JOIN v a ON a.key = p.key JOIN v b ON b.key = p.other AND b.feature = a.feature GROUP BY 1, 2 HAVING sum(a.w * b.w) > 0)
SELECT key, other, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, other) AS rank FROM s) WHERE rank <= 10
""")
def tfidf_related_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.related(_part_features(spark, sf_dir), F.col("key") % 100 == 0)


@query(f"""
WITH {_VECTORS}
SELECT key, CAST(count(*) AS BIGINT) AS n_features, CAST(floor(sum(w) * 10000 + 0.5) AS BIGINT) AS total FROM v GROUP BY key
""")
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _part_features(spark, sf_dir)
    vectors = similarity.weighted(features, similarity.inverse_frequencies(features))
    return vectors.groupBy("key").agg(F.count("*").alias("n_features"), scaled(F.sum("w")).alias("total"))


@query("""
SELECT query, id, CAST(floor(score * 10000 + 0.5) AS BIGINT) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM (
    SELECT q.vec_id AS query, e.vec_id AS id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score
    FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id)) WHERE rank <= 10
""")
def dense_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.nearest(rows.where("id % 100 = 0"), rows).withColumn("score", scaled(F.col("score")))


_GRAMS = f"""
g AS (SELECT item_id AS id, list_distinct(list_transform(range(1, greatest(len(t) - 2, 1) + 1),
  lambda i: substr(sha256(array_to_string(list_slice(t, i, i + 2), chr(31))), 1, 8))) AS keys FROM (SELECT item_id, {_TOKENS} AS t FROM benchmark)),
m AS (SELECT id, keys, list_transform(range(0, 64), lambda i: list_min(list_transform(keys,
  lambda k: CAST('0x' || substr(sha256(CAST(i AS VARCHAR) || ':' || k), 1, 8) AS BIGINT)))) AS signature FROM g)"""


def _fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialised step by step: inside lambdas an inlined expression would be computed again and again."""
    tokens = checkpointed(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), word_tokens(F.col("text")).alias("tokens")))
    counted = checkpointed(tokens.select("id", V.k_grams(F.col("tokens")).alias("grams")))
    return checkpointed(counted.withColumn("signature", V.minhash(F.map_keys("grams"))))


@query(f"""
WITH {_GRAMS}
SELECT id, CAST(len(keys) AS BIGINT) AS n_grams, sha256(array_to_string(list_transform(signature, lambda x: CAST(x AS VARCHAR)), ',')) AS signature FROM m
""")
def minhash_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = F.array_join(F.transform("signature", lambda x: x.cast("string")), ",")
    return _fingerprints(spark, sf_dir).select(
        "id", F.size("grams").cast("long").alias("n_grams"), F.sha2(joined.cast("binary"), 256).alias("signature")
    )


@query(f"""
WITH {_GRAMS},
b AS (SELECT id, i AS band, list_slice(signature, i * 4 + 1, i * 4 + 4) AS part FROM m, unnest(range(0, 16)) AS u(i)),
c AS (SELECT signature, min(id) AS class FROM m GROUP BY signature),
p AS (SELECT DISTINCT u.class AS l, w.class AS r FROM b x JOIN b y USING (band, part) JOIN m s ON s.id = x.id JOIN m t ON t.id = y.id
  JOIN c u ON u.signature = s.signature JOIN c w ON w.signature = t.signature)
SELECT CAST(l AS VARCHAR) AS left_class, CAST(r AS VARCHAR) AS right_class, CAST(floor(len(list_filter(range(1, 65), lambda i: a.signature[i] = c.signature[i])) / 64.0 * 10000 + 0.5) AS BIGINT) AS jaccard
FROM p JOIN m a ON a.id = l JOIN m c ON c.id = r
WHERE len(list_filter(range(1, 65), lambda i: a.signature[i] = c.signature[i])) >= 0.3 * 64
""")
def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = _fingerprints(spark, sf_dir)
    return similarity.lsh_classes(prints, prints)[2].withColumn("jaccard", scaled(F.col("jaccard")))


def _document_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(similarity.text_signatures(table(spark, sf_dir, "documents"), "doc_id", "text"))


@query(None)
def document_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signature of each document and the least id that has the same: the membership of the class pairs below."""
    prints = _document_prints(spark, sf_dir)
    members = similarity.class_members(prints, similarity.signature_classes(prints))
    joined = F.array_join(F.transform("signature", lambda x: x.cast("string")), ",")
    return members.select(F.col("id").alias("doc_id"), "class_id", "n_grams", F.sha2(joined.cast("binary"), 256).alias("signature"))


@query(None)
def est_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of classes of documents that share a band, with the estimate."""
    classes = checkpointed(similarity.signature_classes(_document_prints(spark, sf_dir)))
    return similarity.near_classes(classes).withColumn("jaccard", scaled(F.col("jaccard")))


@query(None)
def document_lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those pairs of classes that are similar enough to be candidates."""
    classes = checkpointed(similarity.signature_classes(_document_prints(spark, sf_dir)))
    return similarity.near_classes(classes).where("jaccard >= 0.3").withColumn("jaccard", scaled(F.col("jaccard")))


@query(None)
def near_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = _document_prints(spark, sf_dir)
    classes = checkpointed(similarity.signature_classes(prints))
    return similarity.near_duplicate_pairs(prints, classes).withColumn("jaccard", scaled(F.col("jaccard")))


_TURNS = f"""
w AS (SELECT conv_id, turn, unnest({_TOKENS}) AS token FROM conversations),
c AS (SELECT conv_id, turn, token, count(*) AS n FROM w GROUP BY ALL),
e AS (SELECT DISTINCT conv_id, turn FROM conversations),
p AS (SELECT a.conv_id, a.turn FROM e a JOIN e b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, turn, left, right): token counts of each turn and the next one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode_outer(word_tokens(F.col("text"))).alias("token"))
    counts = turns.groupBy("conv_id", "turn", "token").agg(F.count("token").alias("n"))
    entries = F.collect_list(F.when(F.col("token").isNotNull(), F.struct("token", "n")))
    maps = counts.groupBy("conv_id", "turn").agg(F.map_from_entries(entries).alias("left"))
    following = maps.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("left").alias("right"))
    return maps.join(following, ["conv_id", "turn"])


@query(f"""
WITH {_TURNS},
nx AS (SELECT conv_id, turn, sqrt(sum(n * n)) AS l FROM c GROUP BY ALL),
d AS (SELECT x.conv_id, x.turn, sum(x.n * y.n) AS dot FROM c x JOIN c y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1 AND x.token = y.token GROUP BY ALL)
SELECT p.conv_id, p.turn, CAST(floor(CASE WHEN a.l IS NULL AND b.l IS NULL THEN 1 WHEN a.l IS NULL OR b.l IS NULL THEN 0 ELSE coalesce(dot, 0) / (a.l * b.l) END * 10000 + 0.5) AS BIGINT) AS cosine
FROM p LEFT JOIN nx a ON a.conv_id = p.conv_id AND a.turn = p.turn LEFT JOIN nx b ON b.conv_id = p.conv_id AND b.turn = p.turn + 1
LEFT JOIN d ON d.conv_id = p.conv_id AND d.turn = p.turn
""")
def map_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", scaled(V.map_cosine(F.col("left"), F.col("right"))).alias("cosine"))


@query(f"""
WITH {_TURNS},
j AS (SELECT p.conv_id, p.turn, coalesce(x.n, 0) AS a, coalesce(y.n, 0) AS b FROM p
  JOIN (SELECT conv_id, turn, token FROM c UNION SELECT conv_id, turn - 1, token FROM c) k ON k.conv_id = p.conv_id AND k.turn = p.turn
  LEFT JOIN c x ON x.conv_id = p.conv_id AND x.turn = p.turn AND x.token = k.token
  LEFT JOIN c y ON y.conv_id = p.conv_id AND y.turn = p.turn + 1 AND y.token = k.token)
SELECT p.conv_id, p.turn, CAST(coalesce(sum(greatest(b - a, 0)), 0) AS BIGINT) AS added, CAST(coalesce(sum(greatest(a - b, 0)), 0) AS BIGINT) AS removed
FROM p LEFT JOIN j ON j.conv_id = p.conv_id AND j.turn = p.turn GROUP BY 1, 2
""")
def map_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda t, x: t + x)
    left, right = F.col("left"), F.col("right")
    return _turn_pairs(spark, sf_dir).select(
        "conv_id", "turn", total(V.map_difference(right, left)).alias("added"), total(V.map_difference(left, right)).alias("removed")
    )


@query(f"""
WITH {_GRAMS},
b AS (SELECT id, i AS band, list_slice(signature, i * 4 + 1, i * 4 + 4) AS part FROM m, unnest(range(0, 16)) AS u(i)),
p AS (SELECT DISTINCT x.id AS t, y.id AS b FROM b x JOIN b y USING (band, part)),
near AS (SELECT t, b FROM p JOIN m x ON x.id = t JOIN m y ON y.id = b WHERE len(list_filter(range(1, 65), lambda i: x.signature[i] = y.signature[i])) >= 0.3 * 64),
w AS (SELECT item_id AS id, unnest(list_transform(range(1, greatest(len(t) - 2, 1) + 1), lambda i: substr(sha256(array_to_string(list_slice(t, i, i + 2), chr(31))), 1, 8))) AS k FROM (SELECT item_id, {_TOKENS} AS t FROM benchmark)),
k AS (SELECT id, k, count(*) AS n FROM w GROUP BY 1, 2), l AS (SELECT id, sqrt(sum(n * n)) AS l FROM k GROUP BY 1),
d AS (SELECT x.id AS t, y.id AS b, sum(x.n * y.n) AS dot FROM k x JOIN k y USING (k) GROUP BY 1, 2),
c AS (SELECT lx.id AS t, ly.id AS b, coalesce(dot, 0) / (lx.l * ly.l) AS cos FROM l lx CROSS JOIN l ly LEFT JOIN d ON d.t = lx.id AND d.b = ly.id),
s AS (SELECT near.t, near.b, x.cos AS before, y.cos AS after FROM near JOIN c x ON x.t = near.t AND x.b = near.b JOIN c y ON y.t = near.t AND y.b = near.b + 1)
SELECT concat('file', t) AS file, concat('item', t) AS name, concat('A-', b) AS advisory, CAST(floor(least(before, 1) * 10000 + 0.5) AS BIGINT) AS score FROM s WHERE before >= 0.55 AND before >= after + 0.05
""")
def fingerprint_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark item as the fixed version of the one before it, matched against all items."""
    prints = _fingerprints(spark, sf_dir)
    function = F.struct(
        F.concat(F.lit("item"), F.col("id").cast("string")).alias("name"), F.lit(1).alias("start_line"), F.lit(60).alias("node_count"),
        "grams", "signature",
        F.array().cast(matching.CALLS).alias("calls"), F.array().cast(matching.GUARDS).alias("guards"),
    )
    functions = prints.select("id", function.alias("f"))
    after = functions.select((F.col("id") - 1).alias("id"), F.col("f").alias("after"))
    corpus = functions.join(after, "id").select(F.concat(F.lit("A-"), "id").alias("advisory"), F.col("f").alias("before"), "after")
    targets = functions.select(F.concat(F.lit("file"), "id").alias("file"), F.col("f").alias("function"))
    return matching.match(targets, corpus).select("file", "name", "advisory", scaled(F.col("score")).alias("score"))
