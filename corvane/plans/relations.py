"""Queries over the relational tables: rollups, windows, intervals, pairs, graphs, metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.scores import scaled
from corvane.operators import comparing, graph, hashtree, intervals, metrics, rollups
from corvane.plans.registry import query
from corvane.session import checkpointed, shared_folder
from corvane.sources.tables import table


@query("""
SELECT CAST(n_regionkey AS BIGINT) AS region, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 250000) AS large
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def project_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    flags = {"finished": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 250000}
    return rollups.project_rollup(joined.withColumn("region", F.col("n_regionkey").cast("long")), "region", flags)


@query("SELECT o_orderpriority AS priority, CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n FROM orders GROUP BY 1, 2")
def year_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.col("o_orderpriority"))
    return rollups.histogram(orders, ["priority"], F.year("o_orderdate").cast("long"), "year")


@query("""
SELECT priority, array_to_string(list_transform(list_sort(list({'y': y, 'n': n})), lambda x: concat(CAST(x.y AS VARCHAR), '=', CAST(x.n AS VARCHAR))), ',') AS years
FROM (SELECT o_orderpriority AS priority, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1
""")
def year_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.col("o_orderpriority"))
    counts = rollups.histogram(orders, ["priority"], F.year("o_orderdate"), "year")
    mapped = rollups.as_map(counts, ["priority"], "year", "n", "years")
    return mapped.select("priority", F.array_join(F.transform(F.map_entries("years"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("years"))


@query("""
SELECT n_name AS nation, CAST(coalesce(n, 0) AS BIGINT) AS n FROM nation LEFT JOIN (
  SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 9900 GROUP BY 1) ON k = n_nationkey
""")
def zero_fill_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY' and c_acctbal > 9900")
    facts = rich.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return rollups.zero_filled(table(spark, sf_dir, "nation"), facts, "n_nationkey", ["n"]).select(F.col("n_name").alias("nation"), "n")


@query("""
SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""")
def grouping_sets_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), "l_quantity")
    return rollups.with_grand_totals(lines, ["flag", "status"], [F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity")])


@query("""
SELECT o_custkey AS custkey, o_orderkey AS orderkey, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rank FROM orders) WHERE rank <= 3
""")
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    return rollups.top_per_group(orders, ["custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("orderkey")], 3).drop("o_orderdate")


@query("SELECT o_custkey AS custkey, arg_min(o_orderkey, o_orderkey) AS orderkey, arg_min(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY 1")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.col("o_orderpriority").alias("priority"))
    return rollups.top_per_group(orders, ["custkey"], [F.col("orderkey")], 1).drop("rank")


@query("""
WITH f AS (SELECT p_type AS family, p_brand AS project, p_partkey AS k, p_retailprice FROM part)
SELECT family, count(*) AS n, count(*) FILTER (p_retailprice > 1500) AS with_fix, min(k) AS least,
  array_to_string(list_slice(list_sort(list(k)), 1, 10), ',') AS examples, count(DISTINCT project) AS n_projects FROM f GROUP BY 1
""")
def pattern_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("family"), F.col("p_brand").alias("project"), F.col("p_partkey").alias("k"), "p_retailprice")
    found = rollups.pattern_families(part, "family", "k", "project", F.col("p_retailprice") > 1500)
    return found.select("family", "n", "with_fix", "least", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"), F.size("projects").cast("long").alias("n_projects"))


@query("""
SELECT doc_key, CAST(least(raw, claimed) AS INTEGER) AS score FROM (
  SELECT c_custkey AS doc_key, CASE WHEN c_acctbal > 0 THEN 40 ELSE 0 END + CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 35 ELSE 0 END + CASE WHEN c_nationkey < 20 THEN 25 ELSE 0 END AS raw,
    CAST(floor(abs(c_acctbal)) AS INTEGER) % 100 AS claimed FROM customer)
""")
def maturity_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [(F.col("c_acctbal") > 0, 40), (F.col("c_mktsegment") != "HOUSEHOLD", 35), (F.col("c_nationkey") < 20, 25)]
    claimed = (F.floor(F.abs("c_acctbal")) % 100).cast("string")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_key"), rollups.maturity(checks, claimed).cast("int").alias("score"))


@query("""
WITH j AS (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders),
r AS (SELECT o_orderkey, place, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'outside_window' WHEN o_orderstatus = 'P' THEN 'no_fix' END AS reason FROM j WHERE place <= 40)
SELECT o_orderkey AS orderkey, CAST(place AS INTEGER) AS place,
  CASE WHEN reason IS NULL AND sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY place) > 8 THEN 'max_records_reached' ELSE reason END AS reason FROM r
""")
def study_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = [("outside_window", F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")), ("no_fix", F.col("o_orderstatus") != "P")]
    found = rollups.study_slice(table(spark, sf_dir, "orders"), tests, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return found.select(F.col("o_orderkey").alias("orderkey"), "place", "reason")


_ISLANDS = """
d AS (SELECT DISTINCT l_orderkey AS orderkey, l_linenumber AS n FROM lineitem),
r AS (SELECT orderkey, n, n - row_number() OVER (PARTITION BY orderkey ORDER BY n) AS g FROM d),
i AS (SELECT orderkey, min(n) AS start, max(n) AS stop, count(*) AS n FROM r GROUP BY orderkey, g)"""


@query(f"WITH {_ISLANDS} SELECT * FROM i")
def gaps_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber")
    return intervals.islands(lines, ["orderkey"], "l_linenumber")


@query("""
WITH s AS (SELECT l_orderkey AS orderkey, CAST(l_linenumber * 3 AS BIGINT) AS a, CAST(l_linenumber * 3 + CAST(l_quantity AS BIGINT) % 3 AS BIGINT) AS b, count(*) AS k FROM lineitem GROUP BY ALL),
f AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY orderkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM s),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY orderkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT orderkey, min(a) AS start, max(b) AS stop, CAST(sum(k) AS BIGINT) AS n FROM g GROUP BY orderkey, run
""")
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.col("l_linenumber") * 3).cast("long")
    spans = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), start.alias("a"), (start + F.col("l_quantity").cast("long") % 3).alias("b"))
    return intervals.merged_intervals(spans, ["orderkey"], "a", "b")


@query("""
WITH e AS (SELECT user_id, event_type, event_id, CAST(epoch(ts) AS BIGINT) AS s, CAST(epoch(ts) AS BIGINT) + CAST(value AS BIGINT) * 30 AS t FROM events)
SELECT a.user_id, a.event_id AS l_id, b.event_id AS r_id FROM e a JOIN e b ON a.user_id = b.user_id AND a.s <= b.t AND b.s <= a.t
WHERE a.event_type = 'error' AND b.event_type = 'purchase'
""")
def interval_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", seconds.alias("s"), (seconds + F.col("value").cast("long") * 30).alias("t"))

    def side(kind: str, name: str) -> DataFrame:
        return events.where(F.col("event_type") == kind).select(
            "user_id", F.col("event_id").alias(f"{name}_id"), F.col("s").alias(f"{name}_start"), F.col("t").alias(f"{name}_stop")
        )

    return intervals.overlapping(side("error", "l"), side("purchase", "r"), ["user_id"], 3600).select("user_id", "l_id", "r_id")


@query("""
SELECT orderkey, l_linenumber AS start, coalesce(lead(l_linenumber) OVER (PARTITION BY orderkey ORDER BY l_linenumber) - 1, 8) AS stop
FROM (SELECT DISTINCT l_orderkey AS orderkey, l_linenumber FROM lineitem)
""")
def region_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("start"), F.lit(8).alias("last")).distinct()
    return intervals.region_ends(lines, ["orderkey"], "start", "last").drop("last")


@query("""
WITH a AS (SELECT conv_id, turn, length(text) AS n FROM conversations WHERE role = 'user'), b AS (SELECT conv_id, turn - 1 AS turn, length(text) AS n FROM conversations WHERE role = 'assistant')
SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.turn, b.turn) AS turn, CAST(coalesce(a.n, -1) AS BIGINT) AS asked, CAST(coalesce(b.n, -1) AS BIGINT) AS answered
FROM (SELECT conv_id, turn, max(n) AS n FROM a GROUP BY ALL) a FULL JOIN (SELECT conv_id, turn, max(n) AS n FROM b GROUP BY ALL) b ON a.conv_id = b.conv_id AND a.turn = b.turn
""")
def pair_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))
    asked = turns.where("role = 'user'").drop("role")
    answered = turns.where("role = 'assistant'").drop("role").withColumn("turn", F.col("turn") - 1)
    pairs = comparing.full_outer(asked, answered, ["conv_id", "turn"], "n")
    return pairs.select("conv_id", "turn", F.coalesce("before.n", F.lit(-1)).alias("asked"), F.coalesce("after.n", F.lit(-1)).alias("answered"))


@query("""
WITH a AS (SELECT o_custkey AS k, any_value(o_orderkey) AS x FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT o_custkey AS k, any_value(o_orderkey) AS x FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 HAVING count(*) = 1)
SELECT k AS custkey, a.x AS before, b.x AS after FROM a JOIN b USING (k)
""")
def unique_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("x"), "o_orderstatus")
    sides = [orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "FP"]
    return comparing.unique_pairs(*sides, ["custkey"]).select("custkey", F.col("before.x").alias("before"), F.col("after.x").alias("after"))


@query("SELECT l_orderkey AS orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY 1")
def orphans_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("orderkey"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return comparing.orphans(lines, parents, ["orderkey"]).groupBy("orderkey").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT o_custkey AS k, o_orderpriority AS p FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_totalprice > 100000)
SELECT side, count(*) AS n FROM ((SELECT 'missing' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT 'extra', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))) GROUP BY 1
""")
def drift_symdiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    pick = lambda where: orders.where(where).select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("p"))
    return comparing.drift(pick("o_orderstatus <> 'P'"), pick("o_totalprice > 100000")).groupBy("side").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 1000 <> 7), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 900 = 3 THEN 'X' ELSE o_orderstatus END FROM orders)
SELECT * FROM ((SELECT 'missing' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT 'extra', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)))
""")
def tree_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a stored table of them in which some rows differ, by the trees of both."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    folder = f"{shared_folder(spark)}/tree-{uuid.uuid4().hex}"
    hashtree.store(orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 900 == 3, "X").otherwise(F.col("o_orderstatus"))), ["o_orderkey"], folder)
    return hashtree.drift(orders.where("o_orderkey % 1000 <> 7"), ["o_orderkey"], folder)


@query("""
SELECT count(*) FILTER (l IS NULL OR r IS NULL) = 0 AS equal, count(*) FILTER (r IS NULL) AS only_left, count(*) FILTER (l IS NULL) AS only_right
FROM (SELECT DISTINCT o_orderkey AS k, 1 AS l FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS k, 1 AS r FROM lineitem) USING (k)
""")
def set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    return comparing.same_ids(left, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("""
SELECT event_type, count(*) AS n FROM (
  SELECT event_type, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS known FROM events)
WHERE known IS NULL OR (known <> '' AND known <= '2024-01-15') GROUP BY 1
""")
def as_of_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    at = F.when(F.col("event_id") % 7 == 0, None).when(F.col("event_id") % 11 == 0, "").otherwise(day)
    events = table(spark, sf_dir, "events").withColumn("at", at)
    return events.where(comparing.as_of(F.col("at"), "2024-01-15")).groupBy("event_type").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey AS orderkey FROM orders WHERE NOT EXISTS (
  SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND NOT (l_linestatus = 'O' OR l_returnflag = 'A'))
""")
def all_valid_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.collect_set(F.concat("l_linestatus", "l_returnflag")).alias("ids"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey")).join(lines, "orderkey", "left")
    valid = F.array(*(F.lit(x) for x in ("OA", "ON", "OR", "FA")))
    return orders.where(comparing.all_valid(F.col("ids"), valid)).select("orderkey")


@query("""
WITH e AS (SELECT DISTINCT concat('s', l_suppkey) AS s, concat('p', l_partkey) AS t FROM lineitem),
b AS (SELECT s, t FROM e UNION SELECT t, s FROM e), h0 AS (SELECT concat('s', s_suppkey) AS root FROM supplier WHERE s_suppkey % 100 = 0),
h1 AS (SELECT DISTINCT root, t AS node FROM h0 JOIN b ON s = root), h2 AS (SELECT DISTINCT root, b.t AS node FROM h1 JOIN b ON s = node WHERE b.t <> root)
SELECT root, hop, count(*) AS n FROM (SELECT root, root AS node, 0 AS hop FROM h0 UNION ALL SELECT root, node, 1 FROM h1
  UNION ALL SELECT root, node, 2 FROM h2 WHERE NOT EXISTS (SELECT 1 FROM h1 WHERE h1.root = h2.root AND h1.node = h2.node)) GROUP BY 1, 2
""")
def bounded_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("s"), "l_suppkey").alias("source"), F.concat(F.lit("p"), "l_partkey").alias("target"))
    seeds = table(spark, sf_dir, "supplier").where("s_suppkey % 100 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("node"))
    roots = checkpointed(graph.numbered_roots(seeds))
    return graph.reach_counts(roots, graph.reach_bits(roots, edges, 2))


@query("""
WITH e AS (SELECT DISTINCT concat('c', o_custkey) AS s, concat('p', l_partkey % 500) AS t FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber = 1),
b AS (SELECT s, t FROM e UNION SELECT t, s FROM e), h0 AS (SELECT DISTINCT s AS root FROM e),
h1 AS (SELECT DISTINCT root, t AS node FROM h0 JOIN b ON s = root), h2 AS (SELECT DISTINCT root, b.t AS node FROM h1 JOIN b ON s = node WHERE b.t <> root)
SELECT root, hop, count(*) AS n FROM (SELECT root, root AS node, 0 AS hop FROM h0 UNION ALL SELECT root, node, 1 FROM h1
  UNION ALL SELECT root, node, 2 FROM h2 WHERE NOT EXISTS (SELECT 1 FROM h1 WHERE h1.root = h2.root AND h1.node = h2.node)) GROUP BY 1, 2
""")
def reach_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and parts that they ordered first: two hops from every customer at once."""
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), F.concat(F.lit("p"), F.col("l_partkey") % 500).alias("target"))
    edges = table(spark, sf_dir, "orders").join(lines, "o_orderkey").select(F.concat(F.lit("c"), "o_custkey").alias("source"), "target")
    edges = checkpointed(edges.distinct())
    roots = checkpointed(graph.numbered_roots(edges.select(F.col("source").alias("node"))))
    return graph.reach_totals(roots, edges, 2)


@query("""
WITH l AS (SELECT DISTINCT l_orderkey AS r, concat('s', l_suppkey) AS s, concat('p', l_partkey) AS t FROM lineitem),
n AS (SELECT r, id, row_number() OVER (PARTITION BY r ORDER BY id) AS place FROM (SELECT r, s AS id FROM l UNION SELECT r, t FROM l)),
c AS (SELECT r, count(*) AS n FROM n GROUP BY 1),
e AS (SELECT l.r, count(*) AS n FROM l JOIN n a ON a.r = l.r AND a.id = l.s AND a.place <= 10 JOIN n b ON b.r = l.r AND b.id = l.t AND b.place <= 10 GROUP BY 1)
SELECT CAST(c.r AS VARCHAR) AS record_id, CAST(least(c.n, 10) AS INTEGER) AS n_nodes, CAST(coalesce(e.n, 0) AS INTEGER) AS n_edges, c.n > 10 AS truncated FROM c LEFT JOIN e USING (r)
""")
def graph_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a record: its parts and suppliers as nodes, its lines as edges, 2 hops, 10 nodes."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("record_id"), F.concat(F.lit("s"), "l_suppkey").alias("source"), F.concat(F.lit("p"), "l_partkey").alias("target")
    ).distinct()
    place = F.row_number().over(Window.partitionBy("record_id").orderBy("id"))
    nodes = lines.select("record_id", F.explode(F.array("source", "target")).alias("id")).distinct().withColumn("ord", place.cast("long"))
    edges = lines.select("record_id", F.lit(0).cast("long").alias("ord"), F.concat_ws(">", "source", "target").alias("id"), "source", "target")
    found = graph.retrieve(nodes, edges)
    return found.select("record_id", F.size("nodes").alias("n_nodes"), F.size("edges").alias("n_edges"), "truncated")


_TAXONOMY = """
n AS (SELECT 'region' AS kind, CAST(r_regionkey AS VARCHAR) AS id, r_name AS label FROM region UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), c_name FROM customer),
e AS (SELECT 'in_region' AS relation, CAST(n_nationkey AS VARCHAR) AS source, CAST(n_regionkey AS VARCHAR) AS target FROM nation
  UNION ALL SELECT 'in_nation', CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) FROM customer)"""


def _taxonomy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    levels = [
        ("region", region.selectExpr("r_regionkey as id", "r_name as label")),
        ("nation", nation.selectExpr("n_nationkey as id", "n_name as label")),
        ("customer", customer.selectExpr("c_custkey as id", "c_name as label")),
    ]
    links = [
        ("in_region", nation.selectExpr("n_nationkey as source", "n_regionkey as target")),
        ("in_nation", customer.selectExpr("c_custkey as source", "c_nationkey as target")),
    ]
    return graph.taxonomy(levels, links)


@query(f"WITH {_TAXONOMY} SELECT * FROM n")
def taxonomy_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taxonomy(spark, sf_dir)[0]


@query(f"WITH {_TAXONOMY} SELECT * FROM e")
def taxonomy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taxonomy(spark, sf_dir)[1]


@query("""
WITH c AS (SELECT quality AS a, toxic AS b, count(*) AS n FROM labels GROUP BY 1, 2), t AS (SELECT sum(n) AS n, sum(n) FILTER (a = b) AS agreed FROM c),
m AS (SELECT sum(x * y) AS chance FROM (SELECT v, sum(x) AS x, sum(y) AS y FROM (SELECT a AS v, n AS x, 0 AS y FROM c UNION ALL SELECT b, 0, n FROM c) GROUP BY v))
SELECT CAST(n AS BIGINT) AS n, CAST(agreed AS BIGINT) AS agreed, CAST(floor((n * agreed - chance) / CAST(n * n - chance AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS kappa FROM t, m
""")
def cohens_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cohens_kappa(table(spark, sf_dir, "labels"), "quality", "toxic").withColumn("kappa", scaled(F.col("kappa")))


@query("""
SELECT o_orderpriority AS priority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'P') AS n_p,
  CAST(floor(count(*) FILTER (o_orderstatus = 'F') / CAST(count(*) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS rate_f,
  CAST(floor(count(*) FILTER (o_orderstatus = 'P') / CAST(count(*) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS rate_p FROM orders GROUP BY 1
""")
def verdict_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("priority", F.col("o_orderpriority"))
    rates = metrics.verdict_rates(orders, ["priority"], "o_orderstatus", ["F", "P"])
    return rates.withColumns({c: scaled(F.col(c)) for c in ("rate_f", "rate_p")})


@query("""
WITH r AS (SELECT source, list(doc_id ORDER BY n_chars DESC, doc_id)[:20] AS ranked FROM documents GROUP BY 1),
x AS (SELECT source, list(doc_id ORDER BY doc_id) AS expected FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY 1),
p AS (SELECT source, ranked, expected, list_filter(range(1, len(ranked) + 1), lambda i: list_contains(expected, ranked[i])) AS places FROM r JOIN x USING (source))
SELECT source, CAST(floor(coalesce(1.0 / places[1], 0) * 10000 + 0.5) AS BIGINT) AS rr,
  CAST(floor(len(list_intersect(ranked[:5], expected)) / CAST(len(expected) AS DOUBLE) * 10000 + 0.5) AS BIGINT) AS recall FROM p
""")
def ranked_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    top = rollups.top_per_group(documents, ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 20)  # a top-k report
    ranked = top.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id"))).alias("r")).select("source", F.col("r.doc_id").alias("ranked"))
    toxic = documents.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id")
    expected = toxic.groupBy("source").agg(F.array_sort(F.collect_list("doc_id")).alias("expected"))
    return ranked.join(expected, "source").select(
        "source",
        scaled(metrics.reciprocal_rank(F.col("ranked"), F.col("expected"))).alias("rr"),
        scaled(metrics.recall_at(F.col("ranked"), F.col("expected"))).alias("recall"),
    )
