"""The facade for interactive use: stats, tree, show, related, search, over an atlas of merged records.

An atlas is a DataFrame (project, id, cwe, group, published, subsystem, fixes array, text). Every
call returns a DataFrame, so results compose; limits are clamped to 1..200 as in any service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import slug
from corvane.operators import rollups, search

MOST = 200
UNKNOWN, OTHER = "Unknown", "Other"


def clamp(limit: int) -> int:
    return max(1, min(MOST, limit))


def with_group(atlas: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds group and its slug: null, '' and UNKNOWN classes are Unknown, unlisted ones Other.

    groups: (cwe, group), one row for each listed class.
    """
    listed = groups.select("cwe", F.col("group").alias("_group"))
    none = F.col("cwe").isNull() | F.col("cwe").isin("", "UNKNOWN")
    named = atlas.join(listed, "cwe", "left").withColumn("group", F.when(none, UNKNOWN).otherwise(F.coalesce("_group", F.lit(OTHER))))
    return named.drop("_group").withColumn("group_slug", slug(F.col("group")))


def stats(atlas: DataFrame) -> DataFrame:
    """Counts by project with a grand total (null project): records, with a fix, with a class."""
    measures = [
        F.count("*").alias("n"),
        F.count_if(F.size("fixes") > 0).alias("with_fix"),
        F.count_if(F.col("cwe").rlike("^CWE-[0-9]+$")).alias("with_cwe"),
    ]
    return rollups.with_grand_totals(atlas, ["project"], measures)


def tree(atlas: DataFrame, cwe: str | None = None, project: str | None = None, limit: int | None = None) -> DataFrame:
    """(group, cwe, n): groups and their classes, the largest first; filters ignore case, limit is per group.

    Groups that a filter leaves empty do not come; a group's total is that of the rows shown.
    """
    rows = atlas
    if cwe is not None:
        rows = rows.where(F.lower("cwe") == cwe.lower())
    if project is not None:
        rows = rows.where(F.lower("project") == project.lower())
    counts = rows.groupBy("group", F.coalesce("cwe", F.lit("UNKNOWN")).alias("cwe")).agg(F.count("*").alias("n"))
    if limit is not None:
        counts = rollups.top_per_group(counts, ["group"], [F.col("n").desc(), F.col("cwe")], limit).drop("rank")
    total = F.sum("n").over(Window.partitionBy("group"))
    return counts.withColumn("group_total", total).orderBy(F.col("group_total").desc(), "group", F.col("n").desc(), "cwe")


def members(atlas: DataFrame, cwe: str) -> DataFrame:
    """The records of a class, newest first; records without a date last."""
    date = F.when(F.col("published") != "", F.col("published"))
    return atlas.where(F.col("cwe") == cwe).orderBy(date.desc_nulls_last(), "id")


def show(atlas: DataFrame, identifier: str, project: str | None = None) -> DataFrame:
    """The record of an id: of several projects the first by name, unless one is named."""
    found = atlas.where(F.col("id") == identifier)
    if project is not None:
        found = found.where(F.col("project") == project)
    return found.orderBy("project").limit(1)


def related(neighbours: DataFrame, identifier: str, limit: int = 10) -> DataFrame:
    """The neighbours (key, other, score, rank) of an id."""
    return neighbours.where(F.col("key") == identifier).orderBy("rank").limit(clamp(limit))


def find(atlas: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Records that hold the text in id, class, project or subsystem."""
    return search.substring_search(atlas, text, ("id", "project", "cwe", "subsystem"), "id", clamp(limit))


def ask(atlas: DataFrame, question: str, limit: int = 5) -> DataFrame:
    """Ranked text search with abstention."""
    return search.bm25(atlas, question, "id", "text", clamp(limit))
