"""Round trips of sinks and readers over the tables, through folders that are removed when the result is written."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.plans.registry import query
from corvane.session import bounded_batches, checkpointed, shared_folder
from corvane.sources import catalogs, readers, sinks, trees
from corvane.sources.tables import table


def _through(spark: SparkSession, use: Callable[[str], DataFrame]) -> DataFrame:
    """What `use` makes of a fresh folder, written before the folder goes."""
    folder = f"{shared_folder(spark)}/roundtrip-{uuid.uuid4().hex}"
    try:
        return checkpointed(use(folder))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_ORDERS = "o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS status, o_orderpriority AS priority"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


@query(f"""
SELECT {_ORDERS}, CASE WHEN o_orderstatus = 'F' THEN 'curl-upstream' ELSE 'git' END AS catalog, CASE WHEN o_orderstatus = 'F' THEN 'curl' ELSE 'git' END AS project, o_orderstatus = 'F' AS auth FROM orders
""")
def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as two catalogs of canonical JSON lines, read back with the project and authority of each."""
    orders = _orders(spark, sf_dir)

    def use(folder: str) -> DataFrame:
        for name, rows in (("curl-upstream", orders.where("status = 'F'")), ("git", orders.where("status <> 'F'"))):
            sinks.write_jsonl(rows, f"{folder}/{name}", ["orderkey"])
        return catalogs.read_catalogs(spark, f"{folder}/*", "orderkey long, custkey long, status string, priority string").drop("file", "block")

    return _through(spark, use)


@query(f"SELECT {_ORDERS}, CAST(o_custkey % 8 AS INTEGER) AS shard FROM orders WHERE o_custkey % 8 = 3")
def entity_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shard of orders that were written as eight."""
    orders = _orders(spark, sf_dir).withColumn("shard", (F.col("custkey") % 8).cast("int"))

    def use(folder: str) -> DataFrame:
        sinks.write_entities(orders, folder, "shard", ["custkey", "orderkey"])
        return spark.read.schema("orderkey long, custkey long, status string, priority string, shard int").json(folder).where("shard = 3")

    return _through(spark, use)


@query("""
SELECT 1 AS step, true AS wrote, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 2, false, (SELECT count(*) FROM orders)
UNION ALL SELECT 3, true, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)
""")
def write_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is written, offered again in another order, and changed."""
    orders = _orders(spark, sf_dir)

    def use(folder: str) -> DataFrame:
        states = []
        for step, rows in enumerate((orders, orders.orderBy(F.col("orderkey").desc()), orders.where("orderkey % 2 = 0")), 1):
            wrote = sinks.write_if_changed(rows, f"{folder}/table")
            states.append((step, wrote, spark.read.parquet(f"{folder}/table").count()))
        return spark.createDataFrame(states, "step int, wrote boolean, n long")

    return _through(spark, use)


@query("""
SELECT concat('INSERT INTO supplier VALUES (', s_suppkey, ', ''', replace(s_name, '''', ''''''), ''', ', s_nationkey, ', NULL, ''[1,', s_nationkey, ']'');') AS value FROM supplier
""")
def sql_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.lit(None).cast("string").alias("none"), F.array(F.lit(1), F.col("s_nationkey").cast("int")).alias("both"))
    return sinks.insert_statements(rows, "supplier")


@query("SELECT 'CHANGED' AS state, 1 AS n UNION ALL SELECT 'EXTRA', 1 UNION ALL SELECT 'MISSING', 1 UNION ALL SELECT 'OK', (SELECT count(*) FROM nation) - 2 UNION ALL SELECT 'UNSAFE', 1")
def manifest_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with a file for each nation against a manifest that is wrong about some of them."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("value"))

    def use(folder: str) -> DataFrame:
        nation.repartition("nation").write.partitionBy("nation").text(folder)
        files = sinks.manifest(spark, folder).where("path like '%.txt'")
        listed = files.where("path not like '%nation=3/%'").withColumn("bytes", F.when(F.col("path").contains("nation=5/"), 0).otherwise(F.col("bytes")))
        more = spark.createDataFrame([("gone.txt", "0" * 64, 1), ("../up.txt", "0" * 64, 1)], "path string, sha256 string, bytes long")
        checked = trees.verify_manifest(spark, folder, listed.unionByName(more)).where("path like '%.txt'")
        return checked.groupBy("state").agg(F.count("*").alias("n"))

    return _through(spark, use)


@query("SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS bytes, md5(coalesce(text, '')) AS digest FROM documents WHERE doc_id % 7 = 3")
def zip_members_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as members of archives; those of one folder read back, by a filter that reaches the archives.

    A member that doesn't come back ends the query.
    """
    readers.register(spark)
    bounded_batches(spark)
    folder = f"{shared_folder(spark)}/zips-{uuid.uuid4().hex}"
    member = F.concat_ws("/", F.concat(F.lit("d"), (F.col("doc_id") % 7).cast("string")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    table(spark, sf_dir, "documents").select(member.alias("member"), "text").write.format("zip_members").option("path", folder).mode("append").save()
    read = spark.read.format("zip_members").options(path=folder, unreadable="fail").load().where(F.col("member").startswith("d3/"))
    return read.select(F.regexp_extract("member", "/([0-9]+)", 1).cast("long").alias("doc_id"), "bytes", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT event_id // 400) AS pages FROM events GROUP BY 1")
def recorded_pages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events recorded as pages of 400, then followed as a stream whose batches have some bytes each, more while much waits."""
    readers.register(spark)
    folder = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 400).alias("page")).agg(F.collect_list(F.struct("event_id", "event_type")).alias("rows"))
    rows.select("page", F.to_json("rows").alias("body")).write.format("recorded_pages").option("path", f"{folder}/recorded").mode("append").save()
    stream = spark.readStream.format("recorded_pages").options(path=f"{folder}/recorded", batch_bytes="256k", catch_up="8").load()
    events = stream.select("page", F.inline(F.from_json("body", "array<struct<event_id: bigint, event_type: string>>")))
    following = events.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").start(f"{folder}/rows")
    try:
        following.processAllAvailable()
    finally:
        following.stop()
    stored = spark.read.schema("page bigint, event_id bigint, event_type string").parquet(f"{folder}/rows")
    return stored.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.countDistinct("page").alias("pages"))
