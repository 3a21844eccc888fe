"""Queries over texts: search, identifiers, JSON, URLs, hashes, audits, families and size gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as T
from corvane.functions.scores import scaled
from corvane.operators import audit, gram_index, merging, search, text_index
from corvane.plans.registry import query
from corvane.sources.tables import table

SEARCHED = "idiot clown worthless trash"
PHRASED = "and_attion thanedble eriner"


def _bm25_sql(phrase_list: list[list[str]], limit: int = 10) -> str:
    def count(phrase: list[str]) -> str:
        if len(phrase) == 1:
            return f"CAST(len(list_filter(t, lambda x: x = '{phrase[0]}')) AS BIGINT)"
        text = " " + "  ".join(phrase) + " "  # tokens stand between two blanks in s
        return f"CAST((length(s) - length(replace(s, '{text}', ''))) / {len(text)} AS BIGINT)"

    counts = ", ".join(f"{count(p)} AS f{k}" for k, p in enumerate(phrase_list))
    ks = range(len(phrase_list))
    dfs = ", ".join(f"count(*) FILTER (f{k} > 0) AS n{k}" for k in ks)
    part = " + ".join(
        f"(CASE WHEN ln((n - n{k} + 0.5) / (n{k} + 0.5)) > 0 THEN ln((n - n{k} + 0.5) / (n{k} + 0.5)) ELSE 1e-6 END) * f{k} * 2.2 / (f{k} + 1.2 * (0.25 + 0.75 * d / a))"
        for k in ks
    )
    terms = " + ".join(f"(CASE WHEN f{k} > 0 THEN 1 ELSE 0 END)" for k in ks)
    return f"""
    WITH tok AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM documents),
    c AS (SELECT doc_id, CAST(len(t) AS DOUBLE) AS d, {counts} FROM (SELECT *, ' ' || array_to_string(t, '  ') || ' ' AS s FROM tok)),
    s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(d) AS a, {dfs} FROM c),
    r AS (SELECT doc_id, -({part}) AS score, CAST({terms} AS BIGINT) AS terms FROM c, s)
    SELECT doc_id, CAST(floor(score * 10000 + 0.5) AS BIGINT) AS score, terms FROM
      (SELECT * FROM r WHERE terms >= 1 AND (terms >= 2 OR score <= -5.0) ORDER BY score, doc_id LIMIT {limit})
    """


def _index(spark: SparkSession, sf_dir: str) -> text_index.TextIndex:
    return text_index.index_of(table(spark, sf_dir, "documents"), "doc_id", "text", f"{sf_dir}/documents")


@query(_bm25_sql(search.phrases(SEARCHED)))
def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).search(SEARCHED, key="doc_id").withColumn("score", scaled(F.col("score")))


@query(_bm25_sql(search.phrases(PHRASED)))
def bm25_phrase_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).search(PHRASED, key="doc_id").withColumn("score", scaled(F.col("score")))


@query(_bm25_sql(search.phrases("worthless the"), 40).replace("FROM documents)", "FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN concat(text, ' worthless') ELSE text END AS text FROM documents))"))
def bm25_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index in three slices, one of which is replaced by changed texts."""
    documents, path = table(spark, sf_dir, "documents"), text_index.new_folder(spark)
    for part in range(3):
        text_index.upsert(documents.where(F.col("doc_id") % 3 == part), "doc_id", "text", path, str(part))
    changed = documents.withColumn("text", F.concat("text", F.lit(" worthless")))
    text_index.upsert(changed.where(F.col("doc_id") % 3 == 1), "doc_id", "text", path, "1")
    return text_index.TextIndex(spark, path).search("worthless the", 40, key="doc_id").withColumn("score", scaled(F.col("score")))


@query("""
SELECT CASE WHEN count(*) > 0 THEN 'EVIDENCE_FOUND' ELSE 'ABSTAIN_NO_MATCH' END AS status, count(*) AS n_found
FROM documents WHERE lower(text) LIKE '%cve-2099-0001%'
""")
def search_abstention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.with_status(search.substring_search(table(spark, sf_dir, "documents"), " CVE-2099-0001 ", ("text",), "doc_id"))


@query("""
SELECT doc_id, source FROM documents
WHERE contains(lower(concat(coalesce(source, ''), ' ', coalesce(lang, ''), ' ', coalesce(text, ''))), 'src1 en the') ORDER BY doc_id LIMIT 50
""")
def substring_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    index = gram_index.index_of(documents, "doc_id", ("source", "lang", "text"), f"{sf_dir}/documents")
    found = index.search(["src1 en the"], "doc_id", 50)
    return documents.select("doc_id", "source").join(F.broadcast(found), "doc_id")  # 50 rows


@query("""
SELECT page_id, url FROM pages
WHERE contains(lower(url), 'example.org') AND contains(lower(url), '/en/') AND contains(lower(url), 'https') ORDER BY page_id LIMIT 200
""")
def token_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = gram_index.index_of(pages, "page_id", ("url",), f"{sf_dir}/pages").search(["example.org", "/en/", "https"], "page_id", 200)
    return pages.select("page_id", "url").join(F.broadcast(found), "page_id")  # 200 rows


@query("""
SELECT page_id, url FROM pages
WHERE list_contains(regexp_extract_all(url, '[a-z]{2}/[0-9]+'), 'en/1') OR list_contains(regexp_extract_all(url, '[a-z]{2}/[0-9]+'), 'en/25')
""")
def exact_id_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    gates = [T.ids_contained(F.lit(x), F.col("url"), "[a-z]{2}/[0-9]+") for x in ("about en/1", "about en/25")]
    return pages.where(gates[0] | gates[1]).select("page_id", "url")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query(r"""
SELECT page_id, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1) AS scheme,
  lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host,
  regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query
FROM pages
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.url_parts(F.col("url")).alias("p")).select("page_id", "p.*")


@query("""
SELECT regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS owner, count(*) AS n_pages, count(DISTINCT host) AS n_hosts
FROM (SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host FROM pages) GROUP BY 1
""")
def host_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = T.url_parts(F.col("url"))["host"]
    pages = table(spark, sf_dir, "pages").select(host.alias("host"))
    owner = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    return pages.groupBy(owner.alias("owner")).agg(F.count("*").alias("n_pages"), F.countDistinct("host").alias("n_hosts"))


@query("""
SELECT doc_id, sha256(coalesce(text, '')) AS sha256,
  sha1(concat('blob ', CAST(octet_length(encode(coalesce(text, ''))) AS VARCHAR), chr(0), coalesce(text, ''))) AS blob
FROM documents
""")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.cast("binary"), 256).alias("sha256"), T.blob_hash(text).alias("blob"))


@query("""
WITH r AS (SELECT sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''))) AS h FROM orders),
c AS (SELECT h, count(*) AS n FROM r GROUP BY h),
b AS (SELECT substr(h, 1, 4) AS bucket, sha256(string_agg(concat(h, ':', n), chr(10) ORDER BY concat(h, ':', n))) AS state, sum(n) AS n FROM c GROUP BY 1)
SELECT sha256(string_agg(concat(bucket, ':', state), chr(10) ORDER BY concat(bucket, ':', state))) AS state, CAST(sum(n) AS BIGINT) AS n_rows FROM b
""")
def table_state_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.state_hash(table(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"])


FAMILIES = [
    ("abuse", "idiot|clown|trash|loser|scum|moron|pathetic|worthless|disgusting|stupid"),
    ("licence", "licensed under|all rights reserved|copyright"),
    ("secret", "token *=|password *=|api_key"),
    ("contact", "@[a-z0-9-]+[.]"),
]


@query(
    "SELECT family, count(*) AS n_docs FROM (SELECT CASE "
    + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{n}'" for n, p in FAMILIES)
    + " ELSE 'other' END AS family FROM documents) GROUP BY 1"
)
def keyword_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.groupBy(T.family(F.col("text"), FAMILIES).alias("family")).agg(F.count("*").alias("n_docs"))


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{r.rule_id}' AS rule_id, '{r.severity}' AS severity, CAST(coalesce(sum(len(regexp_extract_all(text, '{r.pattern}'))), 0) AS BIGINT) AS n_findings, "
        f"count(*) FILTER (regexp_matches(text, '{r.pattern}')) AS n_docs FROM documents"
        for r in audit.TEXT_RULES
    )
    + ")"
)
def regex_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.rule_counts(table(spark, sf_dir, "documents"), "text", audit.TEXT_RULES)


@query(
    "SELECT verdict, count(*) AS n_docs FROM (SELECT doc_id, CASE WHEN max(rank) >= 3 THEN 'FAIL' WHEN max(rank) >= 1 THEN 'WARN' ELSE 'PASS' END AS verdict FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '{r.pattern}') THEN {audit.SEVERITIES.index(r.severity) + 1} ELSE 0 END AS rank FROM documents"
        for r in audit.TEXT_RULES
    )
    + ") GROUP BY doc_id) GROUP BY 1"
)
def audit_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.groupBy(audit.verdict(F.col("text"), audit.TEXT_RULES).alias("verdict")).agg(F.count("*").alias("n_docs"))


#: Words of the texts that become source code, so that rules find something: (word, code).
PLANTED = (
    ("the", "strcpy (to, from);"), ("de", "p = malloc(n * size) ;"), ("der", 'eval "$x"'), ("of", "a.get_unchecked(1)"), ("und", "os.system(x)"), ("la", "/* note */ sprintf (s)"),
)
_SUFFIXES = ("c", "rs", "py", "sh", "txt")


def _replaced(text: str) -> str:
    for word, code in PLANTED:
        text = f"replace({text}, ' {word} ', ' {code} ')"
    return text


@query(rf"""
WITH f AS (SELECT concat('d', doc_id, '.', {list(_SUFFIXES)}[CAST(doc_id % 5 AS INT) + 1]) AS path, doc_id % 5 AS kind, {_replaced("text")} AS text FROM documents),
l AS (SELECT path, kind, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM f),
r AS (SELECT * FROM (VALUES ('SEC-CWE-120-UNBOUNDED-COPY', 'HIGH', 0, '\b(strcpy|strcat|gets|sprintf)\s*\('), ('SEC-CWE-190-INTEGER-OVERFLOW-C', 'MEDIUM', 0, '\b(malloc|kmalloc|kzalloc|vmalloc|xmalloc)\s*\(\s*([a-zA-Z0-9_]+)\s*(\*|\+)\s*([a-zA-Z0-9_]+)\s*(,[^)]+)?\)'),
  ('SEC-CWE-78-COMMAND-INJECTION-C', 'CRITICAL', 0, '\b(system|popen)\s*\(\s*[a-zA-Z0-9_]+'), ('SEC-CWE-78-COMMAND-INJECTION-SHELL', 'CRITICAL', 3, '(eval\s+["'']?\$|\b(sh|bash)\s+-c\s+["'']?\$|\bexec\s+["'']?\$)'), ('SEC-CWE-78-COMMAND-INJECTION-PYTHON', 'CRITICAL', 2, 'os\.(system|popen)\s*\([^)]+\)')) v(rule_id, severity, of, pattern)),
m AS (SELECT path, rule_id, severity, line, t, len(regexp_extract_all(t, pattern)) AS n FROM l JOIN r ON l.kind = r.of OR l.kind = 4)
SELECT path, rule_id, severity, CAST(line AS BIGINT) AS line, md5(regexp_replace(regexp_replace(t, '^\s+', ''), '\s+$', '')) AS snippet,
  CASE rule_id WHEN 'SEC-CWE-120-UNBOUNDED-COPY' THEN 'Copies' ELSE 'Standard Pattern' END AS cluster_title, CASE rule_id WHEN 'SEC-CWE-120-UNBOUNDED-COPY' THEN 'CVE-1' END AS sample
FROM m, unnest(range(n)) WHERE n > 0
""")
def source_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as sources of four languages and an unknown one: all 18 rules, with lines, snippets and samples of clusters."""
    text = F.col("text")
    for word, code in PLANTED:
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {code} "))
    suffix = F.get(F.array(*map(F.lit, _SUFFIXES)), (F.col("doc_id") % 5).cast("int"))
    sources = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("."), suffix).alias("path"), text.alias("text"))
    clusters = spark.createDataFrame([("CWE-120", "Copies", ["CVE-1", "CVE-2"]), ("CWE-999", "Others", [])], "cwe string, title string, samples array<string>")
    found = audit.with_samples(audit.findings(sources, audit.SOURCE_RULES), clusters)
    return found.select("path", "rule_id", "severity", "line", F.md5(F.col("snippet").cast("binary")).alias("snippet"), "cluster_title", "sample")


@query("""
WITH u AS (SELECT p_partkey AS k, octet_length(encode(concat('{"row":{"k":', p_partkey, '},"urls":[]}'))) AS base, p_size * 4 + 3 AS len FROM part)
SELECT k, CAST(CASE WHEN base + 3 * len + 2 <= 500 THEN 3 WHEN base + 2 * len + 1 <= 500 THEN 2 WHEN base + len <= 500 THEN 1 ELSE 0 END AS INTEGER) AS kept FROM u
""")
def size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of three links fit a record of 500 bytes."""
    link = lambda c: F.concat(F.lit(c), F.repeat(F.lit("x"), F.col("p_size") * 4))
    part = table(spark, sf_dir, "part").select(F.struct(F.col("p_partkey").alias("k")).alias("row"), F.array(*map(link, "abc")).alias("urls"))
    return part.select("row.k", F.size(merging.fit_record(F.col("row"), F.col("urls"))).alias("kept"))


@query("""
SELECT doc_id, CAST(w AS VARCHAR) AS first_words, CAST(n AS INTEGER) AS n_distinct FROM (
  SELECT doc_id, array_to_string(list_slice(u, 1, 5), ' ') AS w, least(len(u), 32) AS n FROM (
    SELECT doc_id, list_transform(list_sort(list_transform(map_entries(m), lambda e: {'p': e.value, 'w': e.key})), lambda x: x.w) AS u FROM (
      SELECT doc_id, map_from_entries(list_transform(list_distinct(t), lambda x: {'k': x, 'v': list_position(t, x)})) AS m FROM (
        SELECT doc_id, list_filter(string_split_regex(replace(lower(text), 'ß', 'ss'), '[^\\p{L}\\p{N}_]+'), lambda x: x <> '') AS t FROM documents))))
""")
def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "documents").select("doc_id", T.query_terms(F.col("text")).alias("terms"))
    return terms.select("doc_id", F.array_join(F.slice("terms", 1, 5), " ").alias("first_words"), F.size("terms").alias("n_distinct"))


@query("""
SELECT o_orderkey AS orderkey, sha256(concat('{"cust":', o_custkey, ',"key":', o_orderkey, ',"none":null,"status":"', o_orderstatus, '"}')) AS sha256 FROM orders
""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("key"), F.lit(None).cast("string").alias("none"), F.col("o_orderstatus").alias("status"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.sha2(T.canonical_json(row).cast("binary"), 256).alias("sha256"))
