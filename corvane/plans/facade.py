"""Queries of the facade, citations, explanations, reviews and load states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane import api
from corvane.functions import text as T
from corvane.functions.scores import scaled
from corvane.operators import metrics, mining, rollups, similarity
from corvane.plans.registry import query
from corvane.plans.retrieval import _VECTORS, _part_features
from corvane.sources.tables import table
from corvane.streaming import incremental


def _atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records: type as class, brand as project, dear ones with a fix."""
    part = table(spark, sf_dir, "part")
    atlas = part.select(
        F.col("p_brand").alias("project"), F.concat(F.lit("P-"), "p_partkey").alias("id"), F.col("p_type").alias("cwe"),
        F.when(F.col("p_size") > 5, F.concat(F.lit("20"), F.lpad(F.col("p_size").cast("string"), 2, "0"))).alias("published"), F.col("p_name").alias("subsystem"),
        F.when(F.col("p_retailprice") > 1500, F.array(F.lit("s"))).otherwise(F.array().cast("array<string>")).alias("fixes"), F.col("p_name").alias("text"),
    )
    groups = spark.createDataFrame([("ECONOMY", "Cheap Goods"), ("SMALL", "Small Goods"), ("MEDIUM", "Small Goods")], "cwe string, group string")
    return api.with_group(atlas, groups)


_GROUP = "CASE WHEN p_type = 'ECONOMY' THEN 'Cheap Goods' WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'Small Goods' ELSE 'Other' END"


@query(f"""
SELECT grp AS "group", cwe, n, CAST(sum(n) OVER (PARTITION BY grp) AS BIGINT) AS group_total FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, cwe) AS place FROM (
    SELECT {_GROUP} AS grp, p_type AS cwe, count(*) AS n FROM part WHERE lower(p_brand) = 'brand#7' GROUP BY 1, 2)) WHERE place <= 2
""")
def tree_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.tree(_atlas(spark, sf_dir), project="BRAND#7", limit=2)


@query("""
SELECT p_brand AS project, count(*) AS n, count(*) FILTER (p_retailprice > 1500) AS with_fix, CAST(0 AS BIGINT) AS with_cwe FROM part GROUP BY ROLLUP (p_brand)
""")
def stats_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.stats(_atlas(spark, sf_dir))


@query("""
SELECT id, place FROM (SELECT concat('P-', p_partkey) AS id, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size > 5 THEN concat('20', lpad(CAST(p_size AS VARCHAR), 2, '0')) END DESC NULLS LAST, concat('P-', p_partkey)) AS INTEGER) AS place
FROM part WHERE p_type = 'SMALL') WHERE place <= 5
""")
def class_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = api.members(_atlas(spark, sf_dir), "SMALL").select("project", "id", "published")
    order = [F.col("published").desc_nulls_last(), F.col("id")]
    return rollups.top_per_group(rows, ["project"], order, 5).select("id", F.col("rank").alias("place"))


@query("""
WITH f AS (SELECT p_type AS family, p_type AS cwe, min(p_partkey) AS example FROM part GROUP BY 1),
e AS (SELECT p_partkey AS advisory, p_type AS cwe, concat('s', p_size) AS sha, CASE WHEN p_size < 3 THEN 'pack_record' ELSE 'catalog' END AS kind FROM part),
c AS (SELECT family, advisory, sha, kind FROM f JOIN e USING (cwe) UNION SELECT family, advisory, sha, kind FROM f JOIN e ON advisory = example)
SELECT family, CAST(advisory AS VARCHAR) AS advisory, sha, kind, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY CASE WHEN kind = 'pack_record' THEN 0 ELSE 1 END, CAST(advisory AS VARCHAR), sha) AS place FROM c) WHERE place <= 3
""")
def guardrail_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    families = part.groupBy(F.col("p_type").alias("family")).agg(F.array(F.min("p_partkey").cast("string")).alias("examples")).withColumn("cwe", F.col("family"))
    evidence = part.select(
        F.col("p_partkey").cast("string").alias("advisory"), F.col("p_type").alias("cwe"), F.concat(F.lit("s"), "p_size").alias("sha"),
        F.when(F.col("p_size") < 3, "pack_record").otherwise("catalog").alias("kind"),
    )
    return mining.citations(families, evidence)


@query(f"""
WITH {_VECTORS},
q AS (SELECT p_partkey AS key, p_partkey + 1 AS other FROM part WHERE p_partkey % 100 = 0),
b AS (SELECT q.key, q.other, a.feature, a.w * c.w AS x FROM q JOIN v a ON a.key = q.key JOIN v c ON c.key = q.other AND c.feature = a.feature)
SELECT key, other, string_agg(feature, ',' ORDER BY x DESC, feature) AS reasons FROM b GROUP BY 1, 2
""")
def related_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _part_features(spark, sf_dir)
    vectors = similarity.weighted(features, similarity.inverse_frequencies(features))
    pairs = table(spark, sf_dir, "part").where("p_partkey % 100 = 0").select(F.col("p_partkey").alias("key"), (F.col("p_partkey") + 1).alias("other"))
    return similarity.explain_pairs(vectors, pairs).withColumn("reasons", F.array_join("reasons", ","))


@query("""
WITH r AS (SELECT o_custkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS reviewer, o_orderkey % 40 > 0 AS expect FROM orders), i AS (SELECT id, count(DISTINCT reviewer) AS n, count(DISTINCT expect) FILTER (reviewer IS NOT NULL) AS o FROM r GROUP BY 1)
SELECT count(*) AS items, count(*) FILTER (n = 1) AS single, count(*) FILTER (n = 0) AS unreviewed, count(*) FILTER (n >= 2) AS paired, count(*) FILTER (n >= 2 AND o = 1) AS agreed, (SELECT count(DISTINCT reviewer) FROM r) AS reviewers FROM i
""")
def reviewer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("reviewer"), (F.col("o_orderkey") % 40 > 0).alias("expect"))
    return metrics.reviewer_summary(reviews)


@query("""
WITH s AS (SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_discount >= 0.09)
SELECT count(*) AS strong, count(*) FILTER (strftime(o_orderdate, '%Y-%m-%d') > '1999-01-01') AS later_fixed, count(*) FILTER (l_returnflag <> l_linestatus) AS cross_project,
  CAST(floor(count(*) FILTER (strftime(o_orderdate, '%Y-%m-%d') > '1999-01-01') / CAST(count(*) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS later_share,
  CAST(floor(count(*) FILTER (l_returnflag <> l_linestatus) * 1000.0 / 5000 * 10000 + 0.5) AS BIGINT) AS cross_per_1000 FROM s
""")
def release_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("project"), F.col("l_linestatus").alias("target_project"), F.col("l_orderkey").alias("advisory"), F.when(F.col("l_discount") >= 0.09, 0.95).otherwise(0.5).alias("score")
    )
    published = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("advisory"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"))
    strong = metrics.release_summary(found.where("score >= 0.9").join(published.select("advisory"), "advisory", "left_semi"), published, "1999-01-01", 5000)
    return strong.withColumns({c: scaled(F.col(c)) for c in ("later_share", "cross_per_1000")})


@query("""
SELECT status, count(*) AS n FROM (SELECT CASE WHEN c_nationkey = 0 THEN 'NOT_FETCHED' WHEN c_mktsegment = 'BUILDING' THEN 'SNAPSHOT_COMPLETE' WHEN NOT c_acctbal > 0 THEN 'CURSOR_PAUSED'
  WHEN c_nationkey % 5 = 0 THEN 'OBSERVED_EMPTY' ELSE 'COMPLETE' END AS status FROM customer) GROUP BY 1
""")
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = F.col("c_nationkey")
    found = incremental.status(requests % 5, requests, F.col("c_acctbal") > 0, F.col("c_mktsegment") == "BUILDING")
    return table(spark, sf_dir, "customer").groupBy(found.alias("status")).agg(F.count("*").alias("n"))


@query("""
WITH o AS (SELECT c_nationkey AS nation, count(*) AS total, count(*) FILTER (c_acctbal < 0) AS failed FROM customer GROUP BY 1)
SELECT CAST(nation AS BIGINT) AS nation, CASE WHEN failed = 0 THEN 'OK' WHEN nation % 2 = 0 AND failed < total THEN 'PARTIAL' ELSE 'FAILED' END AS outcome FROM o
""")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("nation")).agg(F.count("*").alias("total"), F.count_if(F.col("c_acctbal") < 0).alias("failed"))
    return counts.select("nation", incremental.outcome(F.col("failed"), F.col("total"), F.col("nation") % 2 == 0).alias("outcome"))


@query("""
SELECT page_id, array_to_string(list_filter(string_split_regex(lower(url), '[/._-]+'), lambda x: length(x) >= 2 AND x NOT IN ('c', 'h', 'cc', 'cpp', 'py', 'rs', 'go', 'js', 'java')), ' ') AS tokens,
  replace(lower(regexp_extract(url, '://([^/]*)', 1)), ' ', '-') AS slug FROM pages
""")
def path_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "://([^/]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(T.path_tokens(F.col("url")), " ").alias("tokens"), T.slug(host).alias("slug"))
