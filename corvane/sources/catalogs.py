"""JSON catalogs and documents as DataFrames with explicit schemas."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ADVISORY = (
    "advisory_id string, published string, cwe string, cwe_state string, patch_urls array<string>, fix_shas array<string>, "
    "subsystem string, fix_sha_source string, cwe_source string, fix_repo string, fixed_in_shas array<string>, aliases array<string>, "
    "package string, reference_commit_shas array<string>, repo string"
)
OVERLAY = "advisory_id string, cwe string, cwe_source string, feed string, feed_ref string, alternates array<string>"
FINGERPRINT_TAG, FRAGMENT_NAME = "schema", r"/([a-zA-Z0-9_-]+)-(CVE-[0-9]+-[0-9]+)\.json$"


def project_of(catalog):
    """A catalog's project: its name without -upstream or -cna, postgres spelt out."""
    bare = F.regexp_replace(catalog, "-(?:upstream|cna)$", "")
    return F.when(bare == "postgres", "postgresql").otherwise(bare)


def read_catalogs(spark: SparkSession, pattern: str, schema: str = ADVISORY, mode: str = "FAILFAST") -> DataFrame:
    """Rows of all JSONL catalogs `<name>/catalog.jsonl` with catalog, project and auth.

    FAILFAST makes a corrupt line fatal, DROPMALFORMED skips it, as overlays want; blank lines never count.
    """
    rows = spark.read.schema(schema).option("mode", mode).json(pattern)
    catalog = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
    named = rows.select("*", catalog.alias("catalog"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return named.withColumns({"project": project_of(F.col("catalog")), "auth": F.col("catalog").rlike("-(?:upstream|cna)$")})


def read_numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSONL rows with their line number, for rules in which the order of lines counts.

    A catalog file is read whole by one task each; it is the unit that its producer writes at once.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line_no", "raw"))
    parsed = lines.where(F.trim("raw") != "").select("file", (F.col("line_no") + 1).alias("line_no"), F.from_json("raw", schema, {"mode": "FAILFAST"}).alias("row"))
    return parsed.select("file", "line_no", "row.*")


def last_line_wins(rows: DataFrame, key: str = "advisory_id") -> DataFrame:
    n = F.row_number().over(Window.partitionBy(key).orderBy(F.col("file").desc(), F.col("line_no").desc()))
    return rows.withColumn("_n", n).where("_n = 1").drop("_n")


def read_documents(spark: SparkSession, folder: str, schema: str, tag: str | None = None, tag_column: str = FINGERPRINT_TAG) -> DataFrame:
    """Whole-document JSON below a folder (index.json left out), filtered by its schema tag, with the path's project and key."""
    found = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(folder)
    path = F.col("_metadata.file_path")
    named = found.select("*", path.alias("file"), F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1).alias("dir"), F.regexp_extract(path, r"/([^/]+)\.json$", 1).alias("name"))
    named = named.where("name <> 'index'")
    return named if tag is None else named.where(F.col(tag_column) == tag)


def file_keys(frame: DataFrame, pattern: str = FRAGMENT_NAME) -> DataFrame:
    """project and advisory_id from file names such as curl-CVE-2030-0001.json; other files are left out."""
    return frame.withColumns({"project": F.regexp_extract("file", pattern, 1), "advisory_id": F.regexp_extract("file", pattern, 2)}).where("advisory_id <> ''")


def point(spark: SparkSession, table: str, **keys: str) -> DataFrame:
    """Rows of a table partitioned by some of the keys: the filter prunes partitions."""
    frame = spark.read.parquet(table)
    for name, value in keys.items():
        if not value or not all(c.isalnum() or c in "-_." for c in value):
            raise ValueError(f"{name}: not an identifier")
        frame = frame.where(F.col(name) == value)
    return frame


def locate(index: DataFrame, key: str, value: str) -> DataFrame:
    """The project of an id: of several the first by name."""
    return index.where(F.col(key) == value).orderBy("project").limit(1).select("project")


def resolve(argument: str | None, variable: str, *folders: str) -> str:
    """The data folder: an argument, else an environment variable, else the first folder that exists."""
    if argument:
        return argument
    if os.environ.get(variable):
        return os.environ[variable]
    for folder in folders:
        if os.path.isdir(os.path.expanduser(folder)):
            return os.path.expanduser(folder)
    raise FileNotFoundError(f"no data folder: pass one, or set {variable}")


def agreeing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of two listings that must name the same keys; a key of one side only is an error."""
    joined = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full_outer")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    checked = F.when(both, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("only on one side: "), F.col(key).cast("string"))))
    return joined.withColumn(key, checked).drop("_l", "_r")
