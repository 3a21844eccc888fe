"""The atlas as files: an index document, search rows, vectors, one file per class; and reading them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.sinks import canonical_column

#: Fixed value: the tag of an index document.
SCHEMA = "site/1"


def index_document(atlas: DataFrame) -> DataFrame:
    """One row (schema, groups, projects, totals) of an atlas (project, id, cwe, group, published, has_fix, has_fragments, has_fingerprint).

    Groups hold their classes with counts by project, projects their counts by year; all sorted by name.
    Everything is counted before it is gathered, so what meets in one row is one entry per class, project and year.
    """
    flags = ("has_fix", "has_fragments", "has_fingerprint")
    sums = [F.count("*").alias("cves"), *(F.count_if(F.col(f)).alias(f.replace("has", "with")) for f in flags)]
    entries = lambda key, value: F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value)))))
    cwe = F.coalesce("cwe", F.lit("UNKNOWN"))
    by_class = atlas.groupBy("group", cwe.alias("id"), "project").agg(F.count("*").alias("n")).groupBy("group", "id").agg(F.sum("n").alias("cves"), entries("project", "n").alias("projects"))
    classes = F.array_sort(F.collect_list(F.struct("id", "cves", F.array_sort(F.map_entries("projects")).alias("projects"))))
    groups = by_class.groupBy(F.col("group").alias("name")).agg(F.sum("cves").alias("cves"), classes.alias("cwes"))
    dated = F.regexp_extract("published", "^([0-9]{4})", 1)
    years = atlas.where(dated != "").groupBy("project", dated.alias("year")).agg(F.count("*").alias("n")).groupBy("project").agg(F.array_sort(F.collect_list(F.struct("year", "n"))).alias("years"))
    projects = atlas.groupBy("project").agg(*sums).join(years, "project", "left")
    names = [c for c in projects.columns if c not in ("project", "years")]
    listed = F.struct(F.col("project").alias("name"), *names, F.coalesce("years", F.array().cast(years.schema["years"].dataType)).alias("years"))
    one = lambda frame, row, name: frame.agg(F.array_sort(F.collect_list(row)).alias(name))
    totals = atlas.agg(F.struct(*sums, F.countDistinct("project").alias("projects")).alias("totals"))
    return (
        totals.crossJoin(one(groups, F.struct("name", "cves", "cwes"), "groups")).crossJoin(one(projects, listed, "projects"))  # one row each
        .select(F.lit(SCHEMA).alias("schema"), "groups", "projects", "totals")
    )


def search_rows(atlas: DataFrame) -> DataFrame:
    """(project, id, cwe, subsystem) of all entries, by id and project."""
    return atlas.select("project", "id", F.coalesce("cwe", F.lit("UNKNOWN")).alias("cwe"), "subsystem").orderBy("id", "project")


def write_site(atlas: DataFrame, vectors: DataFrame, folder: str) -> None:
    """Writes search rows, vectors (id, features as a map), a folder per class, and last the index, which names what is complete."""
    search_rows(atlas).select(canonical_column(search_rows(atlas)).alias("value")).write.mode("overwrite").text(f"{folder}/search")
    ordered = vectors.select("id", "features").orderBy("id")
    ordered.select(canonical_column(ordered).alias("value")).write.mode("overwrite").text(f"{folder}/vectors")
    atlas.withColumn("class", F.coalesce("cwe", F.lit("UNKNOWN"))).sortWithinPartitions("class", "id").write.mode("overwrite").partitionBy("class").json(f"{folder}/cwe")
    index = index_document(atlas)
    index.select(canonical_column(index).alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder}/index")  # one row


def load_index(spark: SparkSession, folder: str, view: str = "site_index") -> DataFrame:
    """The index document, also as a temporary view; another schema is an error when it is read."""
    found = spark.read.json(f"{folder}/index")
    wrong = F.raise_error(F.concat(F.lit("not an index document: "), F.coalesce("schema", F.lit("?")))).cast("string")
    checked = found.withColumn("schema", F.when(F.col("schema") == SCHEMA, F.col("schema")).otherwise(wrong))
    checked.createOrReplaceTempView(view)
    return checked


def load_search(spark: SparkSession, folder: str, view: str = "site_search") -> DataFrame:
    """The search rows, also as a temporary view."""
    found = spark.read.schema("project string, id string, cwe string, subsystem string").json(f"{folder}/search")
    found.createOrReplaceTempView(view)
    return found
