"""Queries of catalogs, validators, versions and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.operators import merging, validating
from corvane.plans.registry import query
from corvane.sources.tables import table
from corvane.streaming import incremental


@query("""
WITH f AS (SELECT o_custkey AS custkey, o_orderstatus AS s, min(o_orderkey) AS f FROM orders GROUP BY 1, 2),
u AS (SELECT custkey, string_agg(s, ',' ORDER BY f) AS states FROM f GROUP BY 1)
SELECT o_custkey AS custkey,
  coalesce(arg_max(o_orderpriority, o_orderkey) FILTER (o_orderstatus = 'F'), arg_min(o_orderpriority, o_orderkey)) AS priority,
  coalesce(arg_max(o_totalprice, o_orderkey) FILTER (o_orderstatus = 'F'), arg_min(o_totalprice, o_orderkey)) AS price,
  any_value(states) AS states
FROM orders JOIN u ON custkey = o_custkey GROUP BY 1
""")
def precedence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"),
        F.array("o_orderstatus").alias("states"), F.col("o_orderkey").alias("ord"), (F.col("o_orderstatus") == "F").alias("auth"),
    )
    merged = merging.merge_catalogs(rows, ["custkey"], ["priority", "price"], ["states"])
    return merged.withColumn("states", F.array_join("states", ","))


@query("""
WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang FROM documents), l AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS lang, 'labels' AS src FROM labels)
SELECT doc_id, coalesce(d.lang, l.lang) AS lang, CASE WHEN d.lang IS NOT NULL THEN 'catalog' WHEN l.lang IS NOT NULL THEN src END AS src FROM d LEFT JOIN l USING (doc_id)
""")
def overlay_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).alias("lang"))
    extra = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("lang"), F.lit("labels").alias("src"))
    return merging.overlay(documents, extra, "doc_id", "lang", "src").select("doc_id", "lang", "src")


@query("""
SELECT doc_id, coalesce(a, b, c) AS value, CASE WHEN a IS NOT NULL THEN 'primary' WHEN b IS NOT NULL THEN 'adp' WHEN c IS NOT NULL THEN 'secondary' END AS source FROM (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source END AS a, CASE WHEN doc_id % 5 = 0 THEN lang END AS b, CASE WHEN doc_id % 2 = 0 THEN 'x' END AS c FROM documents)
""")
def source_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, name = merging.first_source(
        ("primary", F.when(F.col("doc_id") % 3 == 0, F.col("source"))),
        ("adp", F.when(F.col("doc_id") % 5 == 0, F.col("lang"))),
        ("secondary", F.when(F.col("doc_id") % 2 == 0, F.lit("x"))),
    )
    return table(spark, sf_dir, "documents").select("doc_id", value.alias("value"), name.alias("source"))


@query("""
SELECT doc_id, 'labels' AS origin FROM labels UNION ALL SELECT doc_id, 'documents' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def anti_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit("labels").alias("origin"))
    documents = table(spark, sf_dir, "documents").select("doc_id", F.lit("documents").alias("origin"), F.lit(0).alias("ord"))
    return merging.append_missing(labels, documents, ["doc_id"])


@query("""
WITH r AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT 'id' AS rule_id, 'bad id ' || k AS id FROM r WHERE k % 7 = 0 UNION ALL SELECT 'published', CASE WHEN k % 7 = 0 THEN 'bad id ' ELSE 'CVE-' END || k FROM r WHERE c % 5 = 0
UNION ALL SELECT 'links', CASE WHEN k % 7 = 0 THEN 'bad id ' ELSE 'CVE-' END || k FROM r WHERE c % 11 = 0 UNION ALL SELECT 'hashes', CASE WHEN k % 7 = 0 THEN 'bad id ' ELSE 'CVE-' END || k FROM r WHERE c % 13 = 0
UNION ALL SELECT 'cwe', CASE WHEN k % 7 = 0 THEN 'bad id ' ELSE 'CVE-' END || k FROM r WHERE c % 17 = 0 UNION ALL SELECT 'cwe_state', CASE WHEN k % 7 = 0 THEN 'bad id ' ELSE 'CVE-' END || k FROM r WHERE c % 19 = 0
""")
def validator_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as advisories of a catalog, some of which break a rule."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.when(k % 7 == 0, "bad id ").otherwise("CVE-"), k.cast("string")).alias("advisory_id"),
        F.when(c % 5 == 0, "2020-13-01").otherwise("2020-12-01T00:00").alias("published"),
        F.array(F.when(c % 11 == 0, "http://x").otherwise("https://x")).alias("patch_urls"),
        F.array(F.when(c % 13 == 0, "short").otherwise(F.sha1(k.cast("string").cast("binary")))).alias("fix_shas"),
        F.when(c % 17 == 0, "CWE-x").otherwise("CWE-1").alias("cwe"), F.when(c % 19 == 0, "missing").otherwise("stated").alias("cwe_state"),
    )
    return validating.catalog_violations(rows)


@query("""
WITH v AS (SELECT p_partkey, p_size % 10 AS a, p_partkey % 13 AS b, p_partkey % 7 AS c FROM part)
SELECT p_partkey, CASE WHEN (a, b) < (5, 4) THEN '5.4' WHEN (a, b) < (7, 10) THEN '7.10' ELSE '5.4, 7.10' END AS fix, concat(a, '.', b, '.', c) AS version FROM v
""")
def min_fixed_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.concat_ws(".", (F.col("p_size") % 10).cast("string"), (F.col("p_partkey") % 13).cast("string"), (F.col("p_partkey") % 7).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", T.first_fixed(version, F.array(F.lit("7.10"), F.lit("5.4"))).alias("fix"), version.alias("version"))


@query("""
WITH v AS (SELECT p_size % 12 AS a, p_partkey % 13 AS b, p_partkey % 3 AS c, count(*) AS n FROM part GROUP BY 1, 2, 3)
SELECT concat(a, '.', b, CASE c WHEN 0 THEN '-rc1' WHEN 1 THEN '' ELSE '.0' END) AS version, n, CAST(row_number() OVER (ORDER BY a, b, CASE c WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) AS INTEGER) AS place FROM v
""")
def version_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions in order: numbers by value, a word after a number below a further number."""
    tail = F.when(F.col("p_partkey") % 3 == 0, "-rc1").when(F.col("p_partkey") % 3 == 1, "").otherwise(".0")
    version = F.concat((F.col("p_size") % 12).cast("string"), F.lit("."), (F.col("p_partkey") % 13).cast("string"), tail)
    each = table(spark, sf_dir, "part").groupBy(version.alias("version")).agg(F.count("*").alias("n"))  # one row per version
    return each.withColumn("place", F.row_number().over(Window.orderBy(T.version_key(F.col("version")))))


@query("""
SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, CAST(floor(sum(value) * 100 + 0.5) AS BIGINT) AS value FROM events GROUP BY 1, 2
""")
def tumbling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    counts = incremental.tumbling_counts(events, "ts", "1 day", ["event_type"])
    return counts.select(F.col("start").alias("day"), "event_type", "n", F.floor(F.col("value") * 100 + 0.5).cast("long").alias("value"))


@query("""
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1
""")
def tumbling_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("at"))
    first, second = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    return incremental.upsert(first, second, "user_id", "at").select("user_id", "event_id", "event_type")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS stop, count(*) AS n FROM s GROUP BY user_id, session
""")
def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.sessions(table(spark, sf_dir, "events"), "ts", "2 hours", "user_id")


@query("""
SELECT user_id, event_type, min(ts) AS first_ts, count(*) AS n FROM events GROUP BY 1, 2
""")
def watermark_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = incremental.first_seen(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts")
    return first.select("user_id", "event_type", F.col("ts").alias("first_ts"), "n")


@query("""
WITH s AS (SELECT c_custkey AS id, DATE '2020-01-01' + CAST(c_nationkey * 10 AS INTEGER) AS a, DATE '2021-06-30' AS z FROM customer)
SELECT id, strftime(a + CAST(k * 90 AS INTEGER), '%Y-%m-%d') AS slice_start, strftime(least(a + CAST(k * 90 + 89 AS INTEGER), z), '%Y-%m-%d') AS slice_stop FROM s, unnest(range(0, 7)) AS u(k) WHERE a + CAST(k * 90 AS INTEGER) <= z
""")
def window_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey") * 10).alias("start"),
        F.lit("2021-06-30").alias("stop"), F.lit(None).cast("string").alias("cursor"),
    )
    slices = incremental.window_slices(state)
    return slices.select("id", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("slice_start", "slice_stop")))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT s_nationkey AS g, concat('s', s_suppkey) AS a, concat('b', CAST(floor(s_acctbal / 500) AS BIGINT)) AS b FROM supplier),
r AS (SELECT g, a, a AS x FROM e UNION SELECT r.g, r.a, CASE WHEN k.a = r.x THEN k.b ELSE k.a END FROM r JOIN e k ON k.g = r.g AND (k.a = r.x OR k.b = r.x)),
m AS (SELECT g, a, min(x) FILTER (x LIKE 's%') AS root FROM r GROUP BY 1, 2)
SELECT CAST(g AS VARCHAR) AS nation, root AS primary, count(*) - 1 AS n_aliases FROM m GROUP BY 1, 2
""")
def alias_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("string").alias("nation"), F.concat(F.lit("s"), "s_suppkey").alias("id"),
        F.array(F.concat(F.lit("b"), F.floor(F.col("s_acctbal") / 500).cast("string"))).alias("aliases"),
        F.array().cast("array<string>").alias("fixed"), F.lit(None).cast("string").alias("severity"),
    )
    found = merging.alias_components(rows, ["nation"], rank=("s",))
    return found.select("nation", "primary", F.size(F.filter("aliases", lambda a: a.startswith("s"))).cast("long").alias("n_aliases"))
