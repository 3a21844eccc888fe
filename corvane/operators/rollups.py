"""Counts by project, year, class and group, with zero rows where a dimension asks for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def project_rollup(frame: DataFrame, project: str, flags: dict[str, Column]) -> DataFrame:
    """n and the count of each flag by project."""
    return frame.groupBy(project).agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in flags.items()))


def histogram(frame: DataFrame, keys: list[str], bucket: Column, name: str) -> DataFrame:
    return frame.groupBy(*keys, bucket.alias(name)).agg(F.count("*").alias("n"))


def as_map(frame: DataFrame, keys: list[str], bucket: str, value: str, name: str) -> DataFrame:
    """One row per key with a map from bucket to value, sorted by bucket."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(bucket).cast("string").alias("k"), F.col(value).alias("v"))))
    return frame.groupBy(*keys).agg(F.map_from_entries(entries).alias(name))


def zero_filled(dimension: DataFrame, facts: DataFrame, key: str, counts: list[str]) -> DataFrame:
    """All rows of the dimension with the facts' counts, 0 where there are none."""
    return dimension.join(facts, key, "left").fillna(0, counts)


def with_grand_totals(frame: DataFrame, keys: list[str], measures: list[Column]) -> DataFrame:
    """Grouping sets: every prefix of the keys, down to the grand total (null keys)."""
    return frame.rollup(*keys).agg(*measures)


def top_per_group(frame: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; the limit is pushed below the shuffle."""
    return frame.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def pattern_families(frame: DataFrame, family: str, key: str, project: str, fixed: Column, examples: int = 10) -> DataFrame:
    """By family: count, with_fix, the first ids, a project histogram; most frequent first, ties by smallest id."""
    per_project = frame.groupBy(family, project).agg(F.count("*").alias("n"))
    shares = per_project.groupBy(family).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(project), F.col("n"))))).alias("projects"))
    first = top_per_group(frame.select(family, key), [family], [F.col(key)], examples)
    ids = first.groupBy(family).agg(F.array_sort(F.collect_list(key)).alias("examples"))
    counts = frame.groupBy(family).agg(F.count("*").alias("n"), F.count_if(fixed).alias("with_fix"), F.min(key).alias("least"))
    return counts.join(shares, family).join(ids, family).orderBy(F.col("n").desc(), "least")


def class_counts(frame: DataFrame, cwe: str, project: str) -> DataFrame:
    """(cwe, n, projects): counts by class with a map of projects; what is no CWE-<n> counts as UNKNOWN."""
    bucket = F.when(F.col(cwe).rlike("^CWE-[0-9]+$"), F.col(cwe)).otherwise("UNKNOWN")
    each = frame.groupBy(bucket.alias("cwe"), project).agg(F.count("*").alias("n"))
    shares = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(project), F.col("n")))))
    return each.groupBy("cwe").agg(F.sum("n").alias("n"), shares.alias("projects"))


def maturity(checks: list[tuple[Column, int]], claimed: Column) -> Column:
    """Weighted sum of passed checks, not above what is claimed; a claim that is no number counts as 0."""
    raw = sum((F.when(ok, weight).otherwise(0) for ok, weight in checks), F.lit(0))
    return F.least(raw, F.coalesce(claimed.try_cast("int"), F.lit(0)))


def problems(tests: dict[str, Column]) -> Column:
    """Array of the names of the tests that a row fails; a null test fails."""
    return F.filter(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in tests.items())), lambda x: x.isNotNull())


def first_reason(tests: list[tuple[str, Column]]) -> Column:
    """Name of the first failing test, else null."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in tests))


def slice_summary(judged: DataFrame, family: str) -> DataFrame:
    """(coverage, accepted, families) of a study slice: WINDOW_SAMPLED if any row was accepted, else INCOMPLETE; counts by family."""
    kept = judged.where("reason is null").groupBy(F.col(family).alias("family")).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    families = F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "n"))))
    return kept.agg(F.when(total > 0, "WINDOW_SAMPLED").otherwise("INCOMPLETE").alias("coverage"), total.alias("accepted"), families.alias("families"))


def study_slice(frame: DataFrame, tests: list[tuple[str, Column]], order: list[Column], examine: int = 40, keep: int = 8) -> DataFrame:
    """Of the first `examine` rows in order, with the first failing test as `reason`, the first `keep` accepted ones.

    Accepted rows beyond keep get the reason max_records_reached.
    """
    first = frame.orderBy(*order).limit(examine)  # a top-k feature; the windows below see that many rows
    ranked = first.withColumn("place", F.row_number().over(Window.orderBy(*order)))
    judged = ranked.withColumn("reason", first_reason(tests))
    accepted = F.sum(F.when(F.col("reason").isNull(), 1).otherwise(0)).over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return judged.withColumn("reason", F.when(F.col("reason").isNull() & (accepted > keep), "max_records_reached").otherwise(F.col("reason")))
