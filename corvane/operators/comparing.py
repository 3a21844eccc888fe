"""Pairs, set differences, foreign keys and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], order: str, last_wins: bool = True) -> DataFrame:
    """Pairs by key of both sides as structs `before` and `after`; of repeated keys the last (or first) row counts."""

    def one(frame: DataFrame, name: str) -> DataFrame:
        rank = F.col(order).desc() if last_wins else F.col(order).asc()
        n = F.row_number().over(Window.partitionBy(*keys).orderBy(rank))
        rest = [c for c in frame.columns if c not in keys]
        return frame.withColumn("_n", n).where("_n = 1").select(*keys, F.struct(*rest).alias(name))

    return one(left, "before").join(one(right, "after"), keys, "full_outer")


def unique_pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner pairs by key, for keys that occur once on either side."""

    def once(frame: DataFrame, name: str) -> DataFrame:
        rest = [c for c in frame.columns if c not in keys]
        return frame.groupBy(*keys).agg(F.count("*").alias("_n"), F.first(F.struct(*rest)).alias(name)).where("_n = 1").drop("_n")

    return once(left, "before").join(once(right, "after"), keys)


def orphans(frame: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of frame without a parent of the same key."""
    return frame.join(parents.select(*keys).distinct(), keys, "left_anti")


def drift(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows in which two tables differ, as multisets, with the side that has them: missing or extra."""
    columns = expected.columns
    missing = expected.exceptAll(stored.select(columns)).withColumn("side", F.lit("missing"))
    return missing.unionByName(stored.select(columns).exceptAll(expected).withColumn("side", F.lit("extra")))


def same_ids(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: equal, only_left, only_right."""
    marked = left.select(key).distinct().withColumn("l", F.lit(1)).join(right.select(key).distinct().withColumn("r", F.lit(1)), key, "full_outer")
    return marked.agg(
        (F.count_if(F.col("l").isNull() | F.col("r").isNull()) == 0).alias("equal"),
        F.count_if(F.col("r").isNull()).alias("only_left"),
        F.count_if(F.col("l").isNull()).alias("only_right"),
    )


def as_of(column: Column, moment: str | None) -> Column:
    """Whether an item was known at a moment (ISO text): a missing value passes, an empty one fails."""
    if moment is None:
        return F.lit(True)
    return F.when(column.isNull(), True).when(column == "", False).otherwise(column <= moment)


def all_valid(ids: Column, valid: Column) -> Column:
    """Whether all ids are among the valid ones; true for none."""
    return F.forall(F.coalesce(ids, F.array().cast("array<string>")), lambda i: F.array_contains(valid, i))


def added_guards(before: Column, after: Column) -> Column:
    """Guards (kind, vars) of the new version that the old one lacks, once each, sorted."""
    shape = lambda g: F.struct(g["kind"].alias("kind"), g["vars"].alias("vars"))
    return F.array_sort(F.array_except(F.array_distinct(F.transform(after, shape)), F.transform(before, shape)))


def limit_breadth(files: Column, coverage: Column, most: int = 60) -> Column:
    """struct(coverage, files): a fix of more than `most` functions is too broad to keep any."""
    n = F.aggregate(files, F.lit(0), lambda total, f: total + F.size(f["functions"]))
    bare = F.transform(files, lambda f: f.withField("functions", F.slice(f["functions"], 1, 0)))
    return F.when(n > most, F.struct(F.lit("TOO_BROAD").alias("coverage"), bare.alias("files"))).otherwise(
        F.struct(coverage.alias("coverage"), files.alias("files"))
    )
