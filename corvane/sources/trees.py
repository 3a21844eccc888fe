"""Source trees, lock files, manifests and small YAML files."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a walk reads and skips.
EXTENSIONS = ("c", "h", "cc", "cpp", "hpp", "rs", "go", "py", "js", "ts", "java")
SKIPPED = ("node_modules", "target", "build", "dist", "vendor", "third_party")
LOCK_FILES = r"(?:^|/)(?:Cargo\.lock|package-lock\.json|pnpm-lock\.yaml|go\.sum|requirements[^/]*\.txt)$"
LANGUAGES = {"c": "C", "h": "C", "cc": "C++", "cpp": "C++", "hpp": "C++", "rs": "Rust", "go": "Go", "py": "Python", "js": "JavaScript", "ts": "TypeScript", "java": "Java"}


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def language(path: Column) -> Column:
    """The language of a file ending, else null."""
    table = F.create_map(*(F.lit(x) for pair in LANGUAGES.items() for x in pair))
    return F.try_element_at(table, extension(path))


def walk(
    spark: SparkSession,
    root: str,
    extensions: tuple[str, ...] = EXTENSIONS,
    skipped: tuple[str, ...] = SKIPPED,
    max_bytes: int = 1 << 20,
    max_files: int | None = None,
) -> DataFrame:
    """(path, relative, length, text, readable) of a tree's source files, without skipped and hidden folders.

    Endings are a filter of the listing and the length one of the metadata, so what they exclude is not read. A file that is no UTF-8
    has a null text and readable = false, for audits to report. max_files keeps the first by path.
    """
    either = lambda word: "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)
    glob = "*.{" + ",".join(either(e.lstrip(".")) for e in extensions) + "}"  # other files are not even listed
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    relative = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root.rstrip("/")) + "/", "")
    folders = F.slice(F.split(relative, "/"), F.lit(1), F.size(F.split(relative, "/")) - 1)
    wanted = files.where(F.col("length") <= max_bytes).withColumn("relative", relative)
    wanted = wanted.where(extension(F.col("path")).isin(*extensions))
    wanted = wanted.where(~F.exists(folders, lambda p: p.isin(*skipped) | p.startswith(".")))
    if max_files is not None:
        wanted = wanted.orderBy("path").limit(max_files)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return wanted.select("path", "relative", "length", text.alias("text"), text.isNotNull().alias("readable"))


def without_prefixes(frame: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows under none of the prefixes."""
    under = reduce(Column.__or__, (F.col(column).startswith(p) for p in prefixes), F.lit(False))
    return frame.where(~under)


def lock_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of all lock files below a folder."""
    files = spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(F.col("path").rlike(LOCK_FILES))


def verify_manifest(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """manifest (path, sha256, bytes) with state: OK, MISSING, CHANGED or UNSAFE; unlisted files come as EXTRA."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    relative = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root.rstrip("/")) + "/", "")
    found = files.select(relative.alias("path"), F.sha2("content", 256).alias("_sha"), F.col("length").alias("_bytes"))
    unsafe = F.col("path").rlike(r"(?:^|/)\.\.(?:/|$)|^/|\\")
    joined = manifest.join(found, "path", "full_outer")
    state = (
        F.when(F.col("sha256").isNull(), "EXTRA").when(unsafe, "UNSAFE").when(F.col("_sha").isNull(), "MISSING")
        .when((F.col("_sha") == F.col("sha256")) & (F.col("_bytes") == F.col("bytes")), "OK").otherwise("CHANGED")
    )
    return joined.select("path", "sha256", "bytes", state.alias("state"))


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value) of the scalars of small YAML files, nested keys joined by dots, list places as numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        def flat(value: object, key: str) -> Iterator[tuple[str, str | None]]:
            if isinstance(value, dict):
                for k, v in value.items():
                    yield from flat(v, f"{key}.{k}" if key else str(k))
            elif isinstance(value, list):
                for k, v in enumerate(value):
                    yield from flat(v, f"{key}.{k}")
            else:
                yield key, None if value is None else str(value)

        for batch in batches:
            rows = [(p, k, v) for p, text in batch.itertuples(index=False) for k, v in flat(yaml.safe_load(text), "")]
            yield pd.DataFrame(rows, columns=["path", "key", "value"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.mapInPandas(run, "path string, key string, value string")


def recorded_responses(spark: SparkSession, path: str, schema: str, most_bytes: int = 1 << 24) -> DataFrame:
    """Rows of recorded service responses, one JSON document per file and page, in page order; a page above the byte cap is an error."""
    files = spark.read.format("binaryFile").load(path)
    size = F.when(F.col("length") <= most_bytes, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("too large: "), F.col("path"))).cast("binary"))
    page = F.regexp_extract("path", r"([0-9]+)\.json$", 1).try_cast("int")
    return files.select("path", page.alias("page"), F.from_json(size.cast("string"), schema).alias("row")).select("path", "page", "row.*")
