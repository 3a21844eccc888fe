"""Queries of advisory scalars, the atlas, fixes, lock files, guards and gates, over tables that stand in for feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import advisories as A
from corvane.operators import atlas, audit, dependencies, matching, merging, mining, rollups
from corvane.plans.registry import query
from corvane.session import checkpointed
from corvane.sources import packs
from corvane.sources.tables import table
from corvane.streaming import refresh

#: URLs that orders refer to, by their key.
URLS = (
    "https://curl.se/docs", "https://github.com/curl/curl/issues", "https://github.com/git/git/pull", "https://lore.kernel.org/git/x", "https://sourceware.org/bugzilla?glibc",
    "https://trac.nginx.org/nginx/ticket", "https://example.org/curl/nginx", "https://www.openssl.org/news", "https://github.com/NLnetLabs/unbound", "https://nlnetlabs.nl/other",
)
_URL_SQL = "[" + ", ".join(f"'{u}'" for u in URLS) + f"][CAST(o_orderkey % {len(URLS)} AS INT) + 1]"


def _url() -> Column:
    return F.concat(F.get(F.array(*(F.lit(u) for u in URLS)), (F.col("o_orderkey") % len(URLS)).cast("int")), F.lit("/"), F.col("o_orderkey").cast("string"))


@query(f"""
WITH r AS (SELECT lower(concat({_URL_SQL}, '/', o_orderkey)) AS u FROM orders), h AS (SELECT u, split_part(split_part(u, '://', 2), '/', 1) AS host FROM r)
SELECT count(*) FILTER (contains(host, 'curl.se') OR contains(host, 'haxx.se') OR (contains(host, 'github.com') AND contains(u, 'curl'))) AS curl,
  count(*) FILTER ((contains(host, 'github.com') AND contains(u, 'git/git')) OR contains(host, 'git-scm.com') OR (contains(host, 'git.kernel.org') AND contains(u, 'git/git')) OR (contains(host, 'lore.kernel.org') AND contains(u, '/git'))) AS git,
  count(*) FILTER ((contains(host, 'sourceware.org') OR contains(host, 'gnu.org')) AND contains(u, 'libc')) AS glibc,
  count(*) FILTER (contains(host, 'nginx.')) AS nginx, count(*) FILTER (contains(host, 'openssl.org')) AS openssl,
  count(*) FILTER ((contains(host, 'github.com') AND (contains(u, 'unbound') OR contains(u, 'nlnetlabs'))) OR (contains(host, 'nlnetlabs.nl') AND contains(u, 'unbound')) OR contains(host, 'unbound.net')) AS unbound
FROM h
""")
def project_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.array(_url()).alias("refs"))
    names = ("curl", "git", "glibc", "nginx", "openssl", "unbound")
    return rows.agg(*(F.count_if(A.owned_by(n, F.lit(None).cast("string"), F.col("refs"))).alias(n) for n in names))


def _weaknesses() -> Column:
    """Each part's weaknesses: a primary one of its size, and secondary ones with a sentinel where the size is even."""
    value = lambda *texts: F.array(*(F.struct(t.alias("value")) for t in texts))
    size = F.col("p_size").cast("string")
    secondary = F.when(F.col("p_size") % 2 == 0, value(F.lit("NVD-CWE-noinfo"))).otherwise(value(F.concat(F.lit(" cwe-"), size), F.concat(F.lit("CWE-"), (F.col("p_size") + 1).cast("string"))))
    primary = F.when(F.col("p_size") % 3 == 0, value(F.lit("n/a"))).otherwise(value(F.concat(F.lit("CWE-"), size)))
    return F.array(F.struct(F.lit("Secondary").alias("type"), secondary.alias("description")), F.struct(F.lit("Primary").alias("type"), primary.alias("description")))


@query("""
SELECT p_partkey AS partkey,
  CASE WHEN p_size % 2 = 1 THEN 'CWE-' || (p_size + 1) WHEN p_size % 3 <> 0 THEN 'CWE-' || p_size END AS cwe,
  CASE WHEN p_size % 2 = 1 OR p_size % 3 <> 0 THEN 'STATED_BY_ADVISORY' ELSE 'UNKNOWN' END AS state,
  CASE WHEN p_size % 3 <> 0 THEN 'CWE-' || p_size ELSE '' END AS "primary",
  CASE WHEN p_size % 2 = 1 THEN 'CWE-' || p_size || ',CWE-' || (p_size + 1) ELSE '' END AS secondary,
  CAST(1 - p_size % 2 AS INTEGER) AS sentinels,
  CAST(CASE WHEN p_size % 2 = 1 THEN 1 ELSE 0 END AS INTEGER) AS alternates
FROM part
""")
def cwe_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "part").select("p_partkey", "p_size", _weaknesses().alias("w")).select("*", A.cwe_lists(F.col("w")).alias("c"), A.first_cwe(F.col("w")).alias("f"))
    chosen = F.concat(F.lit("CWE-"), F.col("p_size").cast("string"))
    return lists.select(
        F.col("p_partkey").alias("partkey"), "f.cwe", "f.state", F.array_join("c.primary", ",").alias("primary"), F.array_join("c.secondary", ",").alias("secondary"),
        "c.sentinels", A.alternates(F.col("c.distinct"), chosen).alias("alternates"),
    )


@query("""
SELECT p_partkey AS partkey,
  CASE WHEN p_size % 5 = 0 THEN 'https://git.kernel.org/linus/' || sha1(CAST(p_partkey AS VARCHAR)) WHEN p_size % 5 = 1 THEN 'https://github.com/o/' || lower(p_brand) || '/commit/' || sha1(CAST(p_partkey AS VARCHAR)) END AS url,
  CASE WHEN p_size % 2 = 0 THEN CASE WHEN p_size % 5 = 2 THEN 'net' WHEN p_size % 5 = 3 THEN 'bpf' ELSE 'unassigned' END ELSE 'unassigned' END AS by_url,
  CASE WHEN p_size % 4 = 0 THEN 'drivers/d' || p_size WHEN p_size % 4 = 1 THEN 'mm' ELSE 'unassigned' END AS by_path
FROM part
""")
def fix_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit URLs and subsystems by URL and by path."""
    size = F.col("p_size")
    project = F.when(size % 5 == 0, "linux").otherwise("other")
    repository = F.when(size % 5 == 1, F.concat(F.lit("o/"), F.lower("p_brand")))
    urls = F.when(size % 2 == 0, F.array(F.lit("https://x"), F.concat(F.lit("https://k.org/"), F.when(size % 5 == 2, "Net/a").when(size % 5 == 3, "eBPF").otherwise("q"))))
    paths = F.when(size % 4 == 0, F.array(F.lit("/"), F.concat(F.lit("drivers/d"), size.cast("string"), F.lit("/x.c")))).when(size % 4 == 1, F.array(F.lit("mm/slab.c"), F.lit("fs/x.c")))
    sha = F.sha1(F.col("p_partkey").cast("string").cast("binary"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("partkey"), matching.commit_url(project, repository, sha).alias("url"), A.subsystem_of_urls(urls).alias("by_url"), A.subsystem_of_paths(paths).alias("by_path")
    )


_ENTRY = "SELECT o_orderkey AS id, CASE WHEN o_orderpriority LIKE '1%' THEN 'UNKNOWN' ELSE 'CWE-' || (o_custkey % 50) END AS cwe, o_orderstatus AS status FROM orders"


@query(f"""
WITH e AS ({_ENTRY}),
o AS (SELECT DISTINCT 'CWE-' || (n_nationkey * 2) AS cwe, n_name AS title FROM nation), c AS (SELECT 'CWE-' || n_nationkey AS cwe, lower(n_name) AS title FROM nation)
SELECT coalesce(o.title, c.title, CASE WHEN e.cwe = 'UNKNOWN' THEN 'Unstated or Legacy Advisory Without CWE Classification' ELSE e.cwe END) AS title, count(*) AS n
FROM e LEFT JOIN o ON o.cwe = e.cwe LEFT JOIN c ON c.cwe = e.cwe GROUP BY 1
""")
def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cwe = F.when(F.col("o_orderpriority").startswith("1"), "UNKNOWN").otherwise(F.concat(F.lit("CWE-"), (F.col("o_custkey") % 50).cast("string")))
    nation = table(spark, sf_dir, "nation")
    named = lambda number, title: nation.select(F.concat(F.lit("CWE-"), number.cast("string")).alias("cwe"), title.alias("title"))
    entries = table(spark, sf_dir, "orders").select(cwe.alias("cwe"))
    return atlas.with_class_names(entries, named(F.col("n_nationkey"), F.lower("n_name")), named(F.col("n_nationkey") * 2, F.col("n_name"))).groupBy("title").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_linenumber = 2 GROUP BY 1), p AS (SELECT l_orderkey AS id FROM lineitem WHERE l_linenumber = 3 GROUP BY 1)
SELECT o_orderkey AS id, o_orderstatus = 'F' AS has_fix, f.id IS NOT NULL AS has_fragments, p.id IS NOT NULL AS has_fingerprint FROM orders LEFT JOIN f ON f.id = o_orderkey LEFT JOIN p ON p.id = o_orderkey
""")
def atlas_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "orders").select(
        F.lit("p").alias("project"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", F.array(F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("fix_shas")
    )
    lines = table(spark, sf_dir, "lineitem")
    part = lambda number, name: lines.where(F.col("l_linenumber") == number).select(F.lit("p").alias("project"), F.col("l_orderkey").alias("id"), F.lit(number).alias(name)).distinct()
    return atlas.with_details(entries, part(2, "fragment"), part(3, "fingerprint")).select("id", "has_fix", "has_fragments", "has_fingerprint")


@query("""
WITH r AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'CWE-1' END AS cwe, CASE o_custkey % 4 WHEN 0 THEN 'nvd-primary' WHEN 1 THEN 'cisa-adp' END AS s FROM orders)
SELECT 'catalog' AS source, count(*) FILTER (cwe <> '' AND s IS NULL) AS n FROM r UNION ALL SELECT 'nvd-primary', count(*) FILTER (cwe <> '' AND s = 'nvd-primary') FROM r
UNION ALL SELECT 'cisa-adp', count(*) FILTER (cwe <> '' AND s = 'cisa-adp') FROM r UNION ALL SELECT 'nvd-secondary', 0 UNION ALL SELECT 'unknown', count(*) FILTER (cwe = '') FROM r
""")
def provenance_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("o_custkey") % 4 == 0, "nvd-primary").when(F.col("o_custkey") % 4 == 1, "cisa-adp")
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 7 == 0, "").otherwise("CWE-1").alias("cwe"), source.alias("cwe_source"))
    return atlas.provenance_summary(rows, ("nvd-primary", "cisa-adp", "nvd-secondary"))


@query("""
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN lang END AS cwe, source = 'src1' AS own FROM documents), r AS (SELECT t.*, t.cwe IS NULL AND l.doc_id IS NOT NULL AS resolved FROM t LEFT JOIN labels l USING (doc_id))
SELECT count(*) FILTER (resolved) AS overlay_rows, count(*) FILTER (cwe IS NULL) AS before_total, count(*) FILTER (cwe IS NULL) - count(*) FILTER (resolved) AS after_total,
  count(*) FILTER (cwe IS NULL AND own) AS before_project, count(*) FILTER (cwe IS NULL AND own) - count(*) FILTER (resolved AND own) AS after_project FROM r
""")
def overlay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("advisory_id"), F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("cwe"), F.array("source").alias("projects"))
    resolved = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("advisory_id")).where("advisory_id % 3 = 0")
    return atlas.overlay_summary(targets, resolved, "src1")


@query("""
WITH c AS (SELECT s_suppkey, ['CURSOR_PAUSED', 'NOT_FETCHED', 'COMPLETE'][CAST(s_nationkey % 3 AS INT) + 1] AS status FROM supplier), l AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS f FROM lineitem GROUP BY 1)
SELECT count(*) AS project_count, CAST(sum(n) AS BIGINT) AS total_entries, CAST(sum(f) AS BIGINT) AS total_with_fix_sha, CAST(sum(s_suppkey) AS BIGINT) AS total_requests,
  concat_ws(',', count(*) FILTER (status = 'CURSOR_PAUSED'), count(*) FILTER (status = 'NOT_FETCHED'), 0, count(*) FILTER (status = 'COMPLETE'), 0) AS states
FROM c LEFT JOIN l ON l_suppkey = s_suppkey
""")
def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.get(F.array(*(F.lit(s) for s in ("CURSOR_PAUSED", "NOT_FETCHED", "COMPLETE"))), (F.col("s_nationkey") % 3).cast("int"))
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("entries"), F.count_if(F.col("l_returnflag") == "R").alias("with_fix_sha"))
    catalogs = table(spark, sf_dir, "supplier").join(counts, "s_suppkey", "left").select(F.col("s_suppkey").alias("project"), status.alias("status"), "entries", "with_fix_sha", F.col("s_suppkey").alias("requests"))
    states = F.concat_ws(",", *(F.element_at("states", F.lit(s)).cast("string") for s in atlas.CATALOG_STATES))
    return atlas.manifest_rollup(catalogs).withColumn("states", states)


_FIX = "SELECT o_custkey AS id, array_agg(sha1(CAST(o_orderkey AS VARCHAR)) ORDER BY o_orderkey) AS shas FROM orders GROUP BY 1"


def _advisories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as advisories: their orders' hashes as fixes, in order."""
    sha = F.sha1(F.col("o_orderkey").cast("string").cast("binary"))
    placed = F.array_sort(F.collect_list(F.struct("o_orderkey", sha.alias("sha"))))
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("advisory_id")).agg(F.transform(placed, lambda x: x["sha"]).alias("fix_shas"))


@query(f"""
WITH a AS ({_FIX}), e AS (SELECT o_custkey AS id, o_orderkey AS k, sha1(CAST(o_orderkey AS VARCHAR)) AS s FROM orders)
SELECT a.id, len(shas) AS n, count(*) FILTER (k % 5 = 0) AS n_missing, CASE WHEN count(*) FILTER (k % 5 = 0) > 0 THEN 'NOT_IN_MIRROR' ELSE 'VERIFIED_IN_MIRROR' END AS sha_status,
  coalesce(string_agg(s, ',' ORDER BY k) FILTER (k % 3 <> 0), '') AS kept, count(*) FILTER (k % 3 = 0) AS demoted
FROM a JOIN e USING (id) GROUP BY ALL
""")
def fix_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirror status of the fixes, and which of them have one parent."""
    rows = checkpointed(_advisories(spark, sf_dir))
    key = table(spark, sf_dir, "orders").select("o_orderkey", F.sha1(F.col("o_orderkey").cast("string").cast("binary")).alias("sha"))
    status = merging.mirror_status(rows, key.where("o_orderkey % 5 <> 0").select("sha"))
    split = merging.single_parent_fixes(rows, key.select("sha", F.when(F.col("o_orderkey") % 3 == 0, 2).otherwise(1).alias("parents")))
    return status.join(split, "advisory_id").join(rows.select("advisory_id", F.size("fix_shas").cast("long").alias("n")), "advisory_id").select(
        F.col("advisory_id").alias("id"), "n", "n_missing", "sha_status", F.array_join("fix_shas", ",").alias("kept"), F.col("demoted").cast("long").alias("demoted")
    )


@query("""
WITH n AS (SELECT c_custkey AS root, 0 AS ord, c_custkey AS id FROM customer UNION ALL SELECT c_custkey, 1, c_custkey + 1 FROM customer UNION ALL SELECT c_custkey, 2, c_custkey * 2 FROM customer WHERE c_custkey * 2 <> c_custkey + 1),
d AS (SELECT o_custkey AS id, o_orderstatus AS s, min(o_orderkey) AS k FROM orders GROUP BY 1, 2),
j AS (SELECT root, n.id, ord, s, k FROM n JOIN d USING (id)), f AS (SELECT root, s, min(ord * 1000000000000 + k) AS k FROM j GROUP BY 1, 2)
SELECT c_custkey AS root, (SELECT count(DISTINCT id) FROM j WHERE j.root = c_custkey) AS found, coalesce((SELECT string_agg(s, ',' ORDER BY k) FROM f WHERE f.root = c_custkey), '') AS states FROM customer
""")
def alias_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the states of their own orders and of those of two aliases, one hop."""
    key = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(key.alias("advisory_id"), F.array(key + 1, key * 2).alias("aliases"))
    first = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.min("o_orderkey").alias("k"))
    states = F.transform(F.array_sort(F.collect_list(F.struct("k", "o_orderstatus"))), lambda x: x["o_orderstatus"])
    documents = first.groupBy(F.col("o_custkey").alias("id")).agg(states.alias("states"))
    found = merging.alias_documents(rows.withColumn("aliases", F.coalesce("aliases", F.array().cast("array<bigint>"))), documents, ("states",))
    return found.select("root", "found", F.array_join("states", ",").alias("states"))


@query("""
WITH r AS (SELECT concat('Pkg_', p_size, '.', replace(lower(p_brand), '#', 'x')) AS n, p_partkey, p_partkey % 100 AS f FROM part WHERE p_partkey % 3 > 0)
SELECT concat(f, '/requirements.txt') AS path, 'PyPI' AS ecosystem, replace(replace(lower(n), '_', '-'), '.', '-') AS name, concat('1.', p_partkey) AS version FROM r WHERE p_partkey % 3 = 1
UNION ALL SELECT concat(f, '/go.sum'), 'Go', n, concat('v1.', p_partkey) FROM r WHERE p_partkey % 3 = 2
""")
def lock_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lock files written from parts, and read back."""
    part = table(spark, sf_dir, "part").where("p_partkey % 3 > 0")
    name = F.regexp_replace(F.concat(F.lit("Pkg_"), F.col("p_size").cast("string"), F.lit("."), F.lower("p_brand")), "#", "x")
    key = F.col("p_partkey").cast("string")
    pin = F.concat(name, F.lit("==1."), key, F.lit("  # pinned\n"), name, F.lit("=="), key, F.lit(".0 ; python_version > '3'\n-e ."))
    module = F.concat(name, F.lit(" v1."), key, F.lit("+incompatible h1:x=\n"), name, F.lit(" v1."), key, F.lit("/go.mod h1:y="))
    pinned = F.col("p_partkey") % 3 == 1
    line = F.when(pinned, pin).otherwise(module)
    file = F.concat((F.col("p_partkey") % 100).cast("string"), F.when(pinned, "/requirements.txt").otherwise("/go.sum"))
    files = part.groupBy(file.alias("path")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    return dependencies.parse(files).select("path", "ecosystem", "name", "version")


_GUARDS = """
c AS (SELECT l_orderkey AS o, 'f' || (l_suppkey % 5) AS callee, l_linenumber * 3 AS line, CASE WHEN l_partkey % 9 = 0 THEN 'MAX' ELSE 'v' || (l_partkey % 4) END AS var FROM lineitem),
ga AS (SELECT l_orderkey AS o, CASE WHEN l_quantity > 40 THEN 'while' ELSE 'if' END AS kind, l_linenumber * 3 - 1 AS line, 'v' || (l_partkey % 4) AS var FROM lineitem WHERE l_quantity > 15),
gb AS (SELECT l_orderkey AS o, CASE WHEN l_quantity > 40 THEN 'while' ELSE 'if' END AS kind, l_linenumber * 3 - 1 AS line, 'v' || (l_partkey % 4) AS var FROM lineitem WHERE l_quantity > 15 AND l_discount > 0.06),
added AS (SELECT * FROM ga WHERE NOT EXISTS (SELECT 1 FROM gb WHERE gb.o = ga.o AND gb.kind = ga.kind AND gb.var = ga.var)),
many AS (SELECT o, var, count(DISTINCT callee) AS n FROM c GROUP BY 1, 2),
rule AS (SELECT DISTINCT c.o, c.callee FROM c JOIN many USING (o, var) JOIN added g ON g.o = c.o AND g.var = c.var AND c.line - g.line BETWEEN 1 AND 8 WHERE n < 3 AND c.var <> 'MAX'
  AND EXISTS (SELECT 1 FROM c b WHERE b.o = c.o AND b.callee = c.callee AND NOT EXISTS (SELECT 1 FROM gb WHERE gb.o = b.o AND gb.var = b.var AND gb.line < b.line)))"""


@query(f"""
WITH {_GUARDS},
hit AS (SELECT DISTINCT c.o + 1 AS target, c.o, t.line, t.var, t.callee FROM rule c JOIN c t ON t.o = c.o AND t.callee = c.callee WHERE t.var <> 'MAX' AND NOT EXISTS (SELECT 1 FROM gb g WHERE g.o = t.o AND g.var = t.var AND g.line < t.line))
SELECT o AS orderkey, (SELECT count(*) FROM rule WHERE rule.o = hit.o) AS n_rules, string_agg(concat(line, ':', var, ':', callee), ',' ORDER BY line, var, callee) AS missing FROM hit GROUP BY 1
""")
def guard_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as fixes: lines are calls and checks, of which the version before lacks some; what it misses by the rules of its fix."""
    line, var = F.col("l_linenumber").cast("int") * 3, F.concat(F.lit("v"), (F.col("l_partkey") % 4).cast("string"))
    call = F.struct(F.concat(F.lit("f"), (F.col("l_suppkey") % 5).cast("string")).alias("callee"), line.alias("line"), F.array(F.when(F.col("l_partkey") % 9 == 0, "MAX").otherwise(var)).alias("args"))
    guard = F.struct(F.when(F.col("l_quantity") > 40, "while").otherwise("if").alias("kind"), (line - 1).alias("line"), F.array(var).alias("vars"))
    checked = F.col("l_quantity") > 15
    gathered = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(call).alias("calls"), F.collect_list(F.when(checked, guard)).alias("after"), F.collect_list(F.when(checked & (F.col("l_discount") > 0.06), guard)).alias("before")
    )
    side = lambda guards: F.struct("calls", F.col(guards).alias("guards"))
    judged = matching.bound(
        matching.guard_rules(side("before"), side("after")),
        lambda rules: F.struct(F.size(rules).cast("long").alias("n_rules"), matching.missing_guards(side("before"), rules).alias("missing")),
    )
    missing = gathered.select("l_orderkey", F.inline(F.array(judged))).where(F.size("missing") > 0)  # a filter on generated columns doesn't compute them twice
    text = F.transform("missing", lambda m: F.concat_ws(":", m["line"].cast("string"), m["var"], m["callee"]))
    return missing.select(F.col("l_orderkey").alias("orderkey"), "n_rules", F.array_join(text, ",").alias("missing"))


@query("""
WITH r AS (SELECT o_custkey AS target, o_orderkey AS run, CASE WHEN o_custkey % 5 = 0 THEN sha256(o_orderstatus) ELSE sha256('x') END AS head, ['PASS', 'WARN', 'FAIL', 'INCOMPLETE'][CAST(o_custkey % 4 AS INT) + 1] AS verdict FROM orders),
f AS (SELECT target, count(*) AS n, count(DISTINCT head) AS h, arg_min(head, run) AS head, any_value(verdict) AS verdict FROM r GROUP BY 1),
j AS (SELECT f.*, CASE WHEN n < 2 THEN 'runs' WHEN h <> 1 THEN 'not_reproducible' WHEN verdict IN ('INCOMPLETE', 'FAIL') THEN lower(verdict) WHEN verdict = 'WARN' THEN 'warn' WHEN target % 7 = 0 AND head <> sha256('old') THEN 'stale' END AS reason FROM f)
SELECT CASE WHEN reason IS NULL THEN 'AUTHORIZED' WHEN reason = 'stale' THEN 'STALE' ELSE 'REJECTED' END AS status, coalesce(reason, '') AS reason, count(*) AS n FROM j GROUP BY ALL
""")
def gate_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    verdict = F.get(F.array(*(F.lit(v) for v in ("PASS", "WARN", "FAIL", "INCOMPLETE"))), (key % 4).cast("int"))
    runs = table(spark, sf_dir, "orders").select(
        key.alias("target"), F.col("o_orderkey").alias("run"), F.when(key % 5 == 0, sha(F.col("o_orderstatus"))).otherwise(sha(F.lit("x"))).alias("head"), verdict.alias("verdict")
    )
    stored = table(spark, sf_dir, "customer").where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("target"), sha(F.lit("old")).alias("head"))
    return audit.quality_gate(runs, stored).groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT l_orderkey AS r, CASE WHEN l_discount > 0.08 THEN 'INCOMPLETE' ELSE 'OK' END AS c, CASE WHEN l_returnflag = 'R' THEN 'hunk' ELSE 'ast' END AS m FROM lineitem), w AS (SELECT r, max(CASE c WHEN 'OK' THEN 0 ELSE 2 END) AS k FROM f GROUP BY 1),
k(kind, value) AS (VALUES ('record_coverage', 'OK'), ('record_coverage', 'PARSER_SKIPPED'), ('record_coverage', 'INCOMPLETE'), ('function_coverage', 'OK'), ('function_coverage', 'PARSER_SKIPPED'), ('function_coverage', 'INCOMPLETE'), ('method', 'ast'), ('method', 'hunk'), ('method', 'hunk_fallback')),
n AS (SELECT 'record_coverage' AS kind, CASE k WHEN 0 THEN 'OK' ELSE 'INCOMPLETE' END AS value, count(*) AS n FROM w GROUP BY ALL UNION ALL SELECT 'function_coverage', c, count(*) FROM f GROUP BY ALL UNION ALL SELECT 'method', m, count(*) FROM f GROUP BY ALL)
SELECT kind, value, coalesce(n, 0) AS n FROM k LEFT JOIN n USING (kind, value)
""")
def fragment_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    function = F.struct(F.when(F.col("l_discount") > 0.08, "INCOMPLETE").otherwise("OK").alias("coverage"), F.when(F.col("l_returnflag") == "R", "hunk").otherwise("ast").alias("method"))
    grouped = table(spark, sf_dir, "lineitem").select("l_orderkey", function.alias("f")).groupBy(F.col("l_orderkey").alias("record_id")).agg(mining.worst(F.col("f.coverage")).alias("coverage"), F.collect_list("f").alias("functions"))
    return mining.fragment_histograms(grouped)


@query("""
WITH r AS (SELECT concat('k', o_orderkey) AS advisory_id, sha1(CAST(o_orderkey AS VARCHAR)) AS sha, o_orderkey AS k, o_custkey AS c FROM orders),
j AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'no valid 40-hex fix SHA' WHEN k % 13 = 0 THEN 'no https fix URL' WHEN k % 17 = 0 THEN 'fix SHA and fix URL disagree' WHEN c % 3 = 2 THEN 'no declared digest provenance' WHEN k % 19 = 0 THEN 'source record has no pattern family' END AS reason FROM r)
SELECT coalesce(reason, '') AS reason, CASE WHEN reason IS NULL THEN CASE WHEN c % 3 = 1 THEN 'hypothesis' ELSE 'observed' END ELSE '' END AS claim_status, count(*) AS n FROM j GROUP BY ALL
""")
def record_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    sha = F.sha1(k.cast("string").cast("binary"))
    rows = table(spark, sf_dir, "orders").select(
        F.get(F.array(F.lit("curl"), F.lit("git"), F.lit("other")), (c % 3).cast("int")).alias("project"), F.concat(F.lit("k"), k.cast("string")).alias("advisory_id"),
        F.when(k % 11 == 0, F.lit("short")).otherwise(sha).alias("fix_sha"),
        F.concat(F.when(k % 13 == 0, "http").otherwise("https"), F.lit("://github.com/o/r/commit/"), F.when(k % 17 == 0, F.reverse(sha)).otherwise(sha)).alias("fix_url"),
        F.sha2(k.cast("string").cast("binary"), 256).alias("digest"), F.lit("https://x").alias("evidence_url"), F.lit("2020").alias("observed_at"),
        F.when(k % 19 != 0, "overflow").alias("family"), F.lit("CWE-1").alias("cwe"), F.lit("STATED").alias("cwe_state"),
    )
    found = atlas.converted(rows, ("curl",), ("curl", "git"))
    return found.groupBy(F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("claim_status", F.lit("")).alias("claim_status")).agg(F.count("*").alias("n"))


@query("""
WITH c AS (SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS bytes, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS place FROM part), s AS (SELECT *, sum(bytes) OVER (ORDER BY place) AS total FROM c WHERE place <= 100)
SELECT id, bytes FROM s WHERE total <= 2000
""")
def affordable_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("long").alias("bytes"), "p_retailprice")
    return refresh.affordable(work, [F.col("p_retailprice").desc(), F.col("id")], "bytes", 100, 2000).select("id", "bytes")


@query("""
SELECT p_brand AS project, concat_ws('-', min(1990 + p_size), max(1990 + p_size)) AS years FROM part GROUP BY 1
""")
def year_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.concat(F.lit("CVE-"), (F.col("p_size") + 1990).cast("string"), F.lit("-"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_brand", ids.alias("id")).groupBy(F.col("p_brand").alias("project")).agg(atlas.year_span(F.col("id")).alias("years"))


_PACK = """
r AS (SELECT CAST(o_custkey AS VARCHAR) AS id FROM orders GROUP BY 1),
e AS (SELECT CAST(o_custkey AS VARCHAR) AS record_id, CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k FROM orders)"""


@query(f"""
WITH {_PACK}
SELECT 'edge_end' AS rule_id, record_id || '/' || id AS id FROM e WHERE k % 5 = 0
UNION ALL SELECT 'edge_status', record_id || '/' || id FROM e WHERE k % 7 = 0 UNION ALL SELECT 'edge_references', record_id || '/' || id FROM e WHERE k % 11 = 0
""")
def pack_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records of a pack, their orders as nodes, evidence and edges, some of which break a rule."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("record_id"), F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("id"))
    records = orders.select(F.col("record_id").alias("id"), F.lit("p").alias("project"), F.lit("t").alias("title")).distinct()
    nodes = orders.select("record_id", "id", F.lit("commit").alias("kind"), F.lit("l").alias("label"))
    evidence = orders.select("record_id", "id", F.lit("https://x").alias("url"), F.sha2(F.col("id").cast("binary"), 256).alias("sha256"), F.lit("2020").alias("observed_at"))
    edges = orders.select(
        "record_id", "id", F.col("id").alias("source"), F.when(F.col("k") % 5 == 0, "none").otherwise(F.col("id")).alias("target"), F.lit("changes").alias("relation"),
        F.when(F.col("k") % 7 == 0, "refuted").otherwise("unknown").alias("status"), F.lit("2020").alias("known_at"),
        F.when(F.col("k") % 11 == 0, F.array().cast("array<string>")).otherwise(F.array("id")).alias("evidence_ids"),
    )
    claims = orders.select("record_id", "id", F.lit("hypothesis").alias("status"), F.lit("t").alias("text"), F.array("id").alias("evidence_ids"))
    return packs.pack_violations({"records": records, "nodes": nodes, "edges": edges, "evidence": evidence, "claims": claims})


@query("""
WITH r AS (SELECT CASE WHEN o_custkey % 7 = 0 THEN 'UNKNOWN' ELSE concat('CWE-', o_custkey % 20) END AS cwe, o_orderstatus AS s FROM orders), c AS (SELECT cwe, s, count(*) AS n FROM r GROUP BY 1, 2)
SELECT cwe, CAST(sum(n) AS BIGINT) AS n, string_agg(concat(s, ':', n), ',' ORDER BY s) AS projects FROM c GROUP BY 1
""")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cwe = F.when(F.col("o_custkey") % 7 == 0, "not stated").otherwise(F.concat(F.lit("CWE-"), (F.col("o_custkey") % 20).cast("string")))
    counts = rollups.class_counts(table(spark, sf_dir, "orders").select(cwe.alias("cwe"), F.col("o_orderstatus").alias("project")), "cwe", "project")
    entries = F.transform(F.map_entries("projects"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return counts.select("cwe", "n", F.array_join(F.array_sort(entries), ",").alias("projects"))


@query("""
WITH w AS (SELECT p_partkey AS k, ['double free', 'an OUT-OF-BOUNDS read', 'underflow', 'a deadlock', 'permission', 'digest', 'symlink', 'denial of service', 'mishandled', 'nothing', ''][CAST(p_partkey % 11 AS INT) + 1] AS t FROM part)
SELECT k, CASE k % 11 WHEN 0 THEN 'memory-lifetime' WHEN 1 THEN 'bounds' WHEN 2 THEN 'integer' WHEN 3 THEN 'concurrency' WHEN 4 THEN 'authz' WHEN 5 THEN 'crypto' WHEN 6 THEN 'path-resolution' WHEN 7 THEN 'resource-accounting' WHEN 8 THEN 'logic' ELSE 'unknown' END AS sqlite,
  CASE k % 11 WHEN 0 THEN 'memory-lifetime' WHEN 1 THEN 'bounds' WHEN 2 THEN 'integer' ELSE 'logic' END AS qemu FROM w
""")
def pattern_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ("double free", "an OUT-OF-BOUNDS read", "underflow", "a deadlock", "permission", "digest", "symlink", "denial of service", "mishandled", "nothing", "")
    text = F.get(F.array(*(F.lit(w) for w in words)), (F.col("p_partkey") % len(words)).cast("int"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), A.pattern_family("sqlite", text).alias("sqlite"), A.pattern_family("qemu", text).alias("qemu"))


_STATED = ("CVE-2022-26354", "CVE-2023-40360", "CVE-2023-42467", "CVE-2023-0664", "CVE-2022-35414", "CVE-2022-2962", "CVE-2022-26353", "CVE-2024-24474")
_TOLD = ("environment variable", "see CWE-426", "wraparound", "a race condition", "bounds check", "format string", "")
_CLASS = ("CWE-426", "CWE-1200", "CWE-787", "CWE-190", "CWE-416", "CWE-4150")


@query(f"""
WITH p AS (SELECT p_partkey AS k, {list(_STATED)}[CAST(p_partkey % 10 AS INT) + 1] AS i, {list(_TOLD)}[CAST(p_partkey % 7 AS INT) + 1] AS t,
  CASE WHEN p_partkey % 5 = 0 THEN {list(_CLASS)}[CAST(p_size % 6 AS INT) + 1] ELSE '' END AS c FROM part)
SELECT k, CASE WHEN c = 'CWE-426' OR t = 'environment variable' THEN 'authz' WHEN c = 'CWE-787' THEN 'bounds' WHEN c = 'CWE-190' OR t = 'wraparound' THEN 'integer'
    WHEN c = 'CWE-416' THEN 'memory-lifetime' WHEN t = 'a race condition' THEN 'concurrency' WHEN t = 'bounds check' THEN 'bounds' WHEN t = 'format string' THEN 'parser' ELSE 'logic' END AS glibc,
  CASE i WHEN 'CVE-2022-26354' THEN 'memory-lifetime' WHEN 'CVE-2022-26353' THEN 'memory-lifetime' WHEN 'CVE-2023-40360' THEN 'logic' WHEN 'CVE-2022-35414' THEN 'logic' WHEN 'CVE-2023-42467' THEN 'integer'
    WHEN 'CVE-2023-0664' THEN 'authz' WHEN 'CVE-2022-2962' THEN 'concurrency' WHEN 'CVE-2024-24474' THEN 'bounds' ELSE CASE WHEN t = 'a race condition' THEN 'concurrency' ELSE 'logic' END END AS qemu,
  CASE t WHEN 'wraparound' THEN 'integer' WHEN 'a race condition' THEN 'concurrency' WHEN 'bounds check' THEN 'bounds' WHEN 'format string' THEN 'parser' ELSE 'unknown' END AS systemd
FROM p
""")
def stated_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of three projects, with stated classes and with ids whose family a project has fixed."""
    pick = lambda values, k: F.get(F.array(*map(F.lit, values)), F.expr(k).cast("int"))
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), pick(_STATED, "p_partkey % 10").alias("i"), pick(_TOLD, "p_partkey % 7").alias("t"), F.when(F.col("p_partkey") % 5 == 0, F.array(pick(_CLASS, "p_size % 6"))).alias("c")
    )
    text, cve = F.col("t"), F.col("i")
    return rows.select("k", A.pattern_family("glibc", text, F.col("c"), cve).alias("glibc"), A.pattern_family("qemu", text, None, cve).alias("qemu"), A.pattern_family("systemd", text, None, cve).alias("systemd"))


@query("""
WITH d AS (SELECT DISTINCT p_partkey % 200 AS g, concat('lib', p_size) AS name, CAST(p_partkey % 40 AS INT) AS m FROM part),
f AS (SELECT *, CASE g % 4 WHEN 0 THEN 'Cargo.lock' WHEN 1 THEN 'package-lock.json' WHEN 2 THEN 'pnpm-lock.yaml' ELSE 'requirements.txt' END AS file, CASE g % 4 WHEN 0 THEN 'crates.io' WHEN 3 THEN 'PyPI' ELSE 'npm' END AS ecosystem FROM d),
a AS (SELECT s_suppkey AS s, CAST(s_suppkey % 30 AS INT) AS x, concat('lib', s_suppkey % 50 + 1) AS name, CASE s_suppkey % 4 WHEN 1 THEN 'npm' WHEN 2 THEN 'PyPI' WHEN 3 THEN 'crates.io' END AS eco FROM supplier)
SELECT concat('p', g, '/', file) AS path, ecosystem, name, concat('1.', m, '.0') AS version, concat(CASE WHEN s % 3 = 0 THEN 'RUSTSEC-' ELSE 'GHSA-' END, s) AS id,
  CASE WHEN s % 3 = 0 THEN concat('CVE-', s, ',GHSA-', s) ELSE concat('CVE-', s) END AS aliases,
  CASE WHEN s % 3 = 0 THEN concat('1.', x, '.0,1.', x + 7, '.5') ELSE concat('1.', x, '.0') END AS fixed,
  CASE WHEN x > m THEN concat('1.', x, '.0') WHEN s % 3 = 0 AND x + 7 >= m THEN concat('1.', x + 7, '.5') END AS fix,
  CASE WHEN s % 3 = 0 THEN '7.5' WHEN s % 2 = 0 THEN 'HIGH' END AS severity
FROM f JOIN a USING (name) WHERE eco IS NULL OR eco = ecosystem
""")
def dependency_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lock files of four formats written from parts, parsed, matched with advisories of suppliers, twins folded."""
    part = table(spark, sf_dir, "part").select((F.col("p_partkey") % 200).alias("g"), F.col("p_partkey").cast("string").alias("k"), F.concat(F.lit("lib"), "p_size").alias("n"), F.concat(F.lit("1."), F.col("p_partkey") % 40, F.lit(".0")).alias("v"))
    kind = F.col("g") % 4
    line = (
        F.when(kind == 0, F.format_string('[[package]]\nname = "%s"\nversion = "%s"\nsource = "registry+https://index"\n', "n", "v"))
        .when(kind == 1, F.format_string('"node_modules/w%s/node_modules/%s":{"version":"%s"}', "k", "n", "v"))
        .when(kind == 2, F.format_string("  %s@%s:\n    resolution: {integrity: x}\n", "n", "v"))
        .otherwise(F.format_string("%s==%s", "n", "v"))
    )
    lines = F.array_sort(F.collect_list("line"))
    text = (
        F.when(kind == 1, F.concat(F.lit('{"lockfileVersion":3,"packages":{"":{"name":"own"},'), F.array_join(lines, ","), F.lit("}}")))
        .when(kind == 2, F.concat(F.lit("lockfileVersion: '6.0'\n\npackages:\n\n"), F.array_join(lines, "\n")))
        .otherwise(F.array_join(lines, "\n"))
    )
    file = F.when(kind == 0, "Cargo.lock").when(kind == 1, "package-lock.json").when(kind == 2, "pnpm-lock.yaml").otherwise("requirements.txt")
    files = part.withColumn("line", line).groupBy("g").agg(text.alias("text")).select(F.concat(F.lit("p"), F.col("g").cast("string"), F.lit("/"), file).alias("path"), "text")
    key, minor = F.col("s_suppkey"), (F.col("s_suppkey") % 30)
    eco = F.when(key % 4 == 1, "npm").when(key % 4 == 2, "PyPI").when(key % 4 == 3, "crates.io")

    def advisory(prefix: str, aliases, fixed, severity, stated):
        package = F.struct(F.concat(F.lit("lib"), key % 50 + 1).alias("name"), eco.alias("ecosystem"))
        events = F.array(F.struct(F.lit("0").alias("introduced"), F.lit(None).cast("string").alias("fixed")), F.struct(F.lit(None).cast("string").alias("introduced"), fixed.alias("fixed")))
        affected = F.array(F.struct(package.alias("package"), F.array(F.struct(F.lit("SEMVER").alias("type"), events.alias("events"))).alias("ranges")))
        scores = F.when(F.lit(severity).isNotNull(), F.array(F.struct(F.lit(severity).cast("string").alias("score"))))
        return F.concat(F.lit(prefix), key).alias("id"), aliases.alias("aliases"), affected.alias("affected"), scores.alias("severity"), stated.alias("database_severity")

    supplier, cve = table(spark, sf_dir, "supplier"), F.concat(F.lit("CVE-"), key)
    own = supplier.select(*advisory("GHSA-", F.array(cve), F.concat(F.lit("1."), minor, F.lit(".0")), None, F.when((key % 2 == 0) & (key % 3 > 0), "HIGH")))
    twin = supplier.where(key % 3 == 0).select(*advisory("RUSTSEC-", F.array(cve), F.concat(F.lit("1."), minor + 7, F.lit(".5")), "7.5", F.lit(None).cast("string")))
    found = dependencies.package_vulnerabilities(dependencies.parse(files), own.unionByName(twin))
    return found.withColumns({c: F.array_join(c, ",") for c in ("aliases", "fixed")})
