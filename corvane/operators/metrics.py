"""Retrieval metrics, verdict rates, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reciprocal_rank(ranked: Column, expected: Column) -> Column:
    """1 / rank of the first expected item; 0 if none comes, null if nothing is expected."""
    places = F.filter(F.transform(ranked, lambda x, i: F.when(F.array_contains(expected, x), i + 1)), lambda p: p.isNotNull())
    return F.when(F.size(expected) > 0, F.coalesce(1.0 / F.get(places, F.lit(0)), F.lit(0.0)))


def recall_at(ranked: Column, expected: Column, k: int = 5) -> Column:
    """Share of the expected items among the first k; null if nothing is expected."""
    found = F.size(F.array_intersect(F.slice(ranked, 1, k), expected))
    return F.when(F.size(expected) > 0, found / F.size(F.array_distinct(expected)))


def any_complete(records: Column, evidence: Column) -> Column:
    """Whether any retrieved record holds all expected evidence (array of arrays against an array)."""
    return F.exists(records, lambda r: F.size(F.array_except(evidence, r)) == 0)


def citation_completeness(records: Column, evidence: Column, found: Column) -> Column:
    """Share of the pairs of an expected record and a required piece of evidence that the results cite; null if none is required.

    records and evidence: arrays of ids; found: array of (record, evidence, url, sha256). Evidence ids are local to a record, so
    another record's don't count, nor does a citation without a URL or a hash.
    """
    sound = F.filter(found, lambda f: (F.coalesce(f["url"], F.lit("")) != "") & (F.coalesce(f["sha256"], F.lit("")) != ""))
    cited = F.array_distinct(F.transform(sound, lambda f: F.struct(f["record"].alias("r"), f["evidence"].alias("e"))))
    wanted = F.size(F.array_distinct(records)) * F.size(F.array_distinct(evidence))
    hits = F.size(F.filter(cited, lambda p: F.array_contains(records, p["r"]) & F.array_contains(evidence, p["e"])))
    return F.when(wanted > 0, hits / wanted)


def means(frame: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the mean of each column over the queries that have a value, null if none has; and the number of queries."""
    return frame.agg(F.count("*").alias("n"), *(F.avg(F.col(c).cast("double")).alias(c) for c in columns))


def verdict_rates(frame: DataFrame, keys: list[str], verdict: str, names: list[str]) -> DataFrame:
    """n, the count of each verdict and its rate; the rate of nothing is null."""
    grouped = frame.groupBy(*keys) if keys else frame.groupBy()
    counts = grouped.agg(F.count("*").alias("n"), *(F.count_if(F.col(verdict) == v).alias(f"n_{v.lower()}") for v in names))
    return counts.withColumns({f"rate_{v.lower()}": F.try_divide(F.col(f"n_{v.lower()}"), F.col("n")) for v in names})


def cohens_kappa(frame: DataFrame, first: str, second: str) -> DataFrame:
    """One row: n, agreed, kappa of two raters; kappa is null without pairs or if chance agreement is total.

    The integer form (n * agreed - chance) / (n * n - chance) keeps sums exact.
    """
    cells = frame.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count("*").alias("n"))
    sides = cells.select(F.inline(F.array(F.struct(F.col("a").alias("v"), F.col("n").alias("x"), F.lit(0).cast("long").alias("y")), F.struct(F.col("b").alias("v"), F.lit(0).cast("long").alias("x"), F.col("n").alias("y")))))
    margins = sides.groupBy("v").agg((F.sum("x") * F.sum("y")).alias("xy")).agg(F.sum("xy").alias("chance"))
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).alias("agreed"))
    joined = total.crossJoin(F.broadcast(margins))  # one row each
    below = F.col("n") * F.col("n") - F.col("chance")
    return joined.select("n", "agreed", F.when(below > 0, (F.col("n") * F.col("agreed") - F.col("chance")) / below).alias("kappa"))


def reviewer_summary(reviews: DataFrame) -> DataFrame:
    """One row: items, reviewers, reviewed once, never reviewed, paired and agreed (pairs of one opinion), from (id, reviewer, expect)."""
    per_item = reviews.groupBy("id").agg(F.array_sort(F.collect_set("reviewer")).alias("who"), F.countDistinct(F.when(F.col("reviewer").isNotNull(), F.col("expect"))).alias("opinions"))
    who = reviews.agg(F.countDistinct("reviewer").alias("reviewers"))
    return per_item.agg(
        F.count("*").alias("items"),
        F.count_if(F.size("who") == 1).alias("single"),
        F.count_if(F.size("who") == 0).alias("unreviewed"),
        F.count_if(F.size("who") >= 2).alias("paired"),
        F.count_if((F.size("who") >= 2) & (F.col("opinions") == 1)).alias("agreed"),
    ).crossJoin(F.broadcast(who))


def release_summary(found: DataFrame, published: DataFrame, release: str, functions: int) -> DataFrame:
    """One row on strong findings (score >= 0.9) of a release: how many match a later fix, how many another project's.

    found: (project, target_project, advisory, score); published: (advisory, published).
    """
    strong = found.where("score >= 0.9").join(published, "advisory", "left")
    later = F.coalesce("published", F.lit("")) > release
    return strong.agg(
        F.count("*").alias("strong"),
        F.count_if(later).alias("later_fixed"),
        F.count_if(F.col("project") != F.col("target_project")).alias("cross_project"),
    ).withColumns({"later_share": F.try_divide("later_fixed", "strong"), "cross_per_1000": F.try_divide(F.col("cross_project") * 1000.0, F.lit(functions))})
