"""Evidence packs: their tables as views, identity checks of snapshots, and mounting what is intact and valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.validating import record_violations
from corvane.sources.trees import verify_manifest

# The tables of a pack and their columns.
TABLES = {
    "records": "id string, project string, title string, payload string",
    "nodes": "record_id string, ord int, id string, kind string, label string, attributes map<string,string>",
    "edges": "record_id string, ord int, id string, source string, target string, relation string, status string, known_at string, evidence_ids array<string>",
    "evidence": "record_id string, id string, url string, sha256 string, observed_at string, payload string",
    "claims": "record_id string, id string, status string, text string, known_at string, evidence_ids array<string>",
}


def read_pack(spark: SparkSession, folder: str, prefix: str = "pack_") -> dict[str, DataFrame]:
    """The tables of a pack, `<folder>/<name>` as Parquet, read only, and as temporary views `<prefix><name>`.

    A column that a table lacks is null, further ones are kept.
    """
    found = {}
    for name, columns in TABLES.items():
        frame = spark.read.parquet(f"{folder}/{name}")
        for column in columns.split(", "):
            key, kind = column.split(" ", 1)
            if key not in frame.columns:
                frame = frame.withColumn(key, F.lit(None).cast(kind))
        frame.createOrReplaceTempView(prefix + name)
        found[name] = frame
    return found


def pack_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule_id, id) of everything that is wrong with a pack's tables."""
    # a pack's columns are complete: those that are null throughout are not asked for
    asked = {"records": ("id", "project", "title"), "nodes": ("record_id", "id", "kind", "label"), "edges": ("record_id", "id", "source", "target", "relation", "status", "known_at", "evidence_ids")}
    asked |= {"evidence": ("record_id", "id", "url", "sha256", "observed_at"), "claims": ("record_id", "id", "status", "text", "evidence_ids")}
    part = {name: tables[name].select(*columns) for name, columns in asked.items()}
    return record_violations(part["records"], part["nodes"], part["edges"], part["evidence"], part["claims"])


def mount(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> dict[str, DataFrame]:
    """`read_pack` of a folder whose files agree with the manifest (path, sha256, bytes), if there is one, and whose tables
    have no violation; else an error.
    """
    if manifest is not None:
        wrong = verify_manifest(spark, folder, manifest).where("state <> 'OK'").limit(5).collect()
        if wrong:
            raise ValueError(f"the pack differs from its manifest: {[(r['path'], r['state']) for r in wrong]}")
    tables = read_pack(spark, folder)
    bad = pack_violations(tables).orderBy("rule_id", "id").limit(5).collect()
    if bad:
        raise ValueError(f"the pack is not valid: {[tuple(r) for r in bad]}")
    return tables


def checked_snapshot(frame: DataFrame, expected: dict[str, str], records: str = "records") -> DataFrame:
    """The records of a snapshot document, one row each, if it is the one that is expected: every named field has its value and
    there is a record. Otherwise computing the result is an error.
    """
    fits = reduce(lambda ok, kv: ok & F.coalesce(F.col(kv[0]).cast("string") == kv[1], F.lit(False)), expected.items(), F.lit(True))
    some = F.coalesce(F.size(records) > 0, F.lit(False))
    reason = F.when(~fits, "the snapshot is not the one that is expected").when(~some, "the snapshot has no records")
    checked = F.when(reason.isNotNull(), F.raise_error(reason).cast(frame.schema[records].dataType)).otherwise(F.col(records))
    return frame.select(F.explode(checked).alias("record"))
