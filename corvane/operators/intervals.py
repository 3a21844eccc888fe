"""Intervals, runs of numbers and unified diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(frame: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, start, stop, n): runs of consecutive distinct numbers."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    distinct = frame.select(*keys, number).distinct().withColumn("_run", F.col(number) - place)
    return distinct.groupBy(*keys, "_run").agg(F.min(number).alias("start"), F.max(number).alias("stop"), F.count("*").alias("n")).drop("_run")


def merged_intervals(frame: DataFrame, keys: list[str], start: str, stop: str, touch: int = 1) -> DataFrame:
    """(keys, start, stop, n): unions of closed intervals; those at most `touch` apart count as one."""
    before = Window.partitionBy(*keys).orderBy(start, stop).rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*keys).orderBy(start, stop).rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.when(F.col(start) <= F.max(stop).over(before) + touch, 0).otherwise(1)
    runs = frame.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(so_far))
    return runs.groupBy(*keys, "_run").agg(F.min(start).alias("start"), F.max(stop).alias("stop"), F.count("*").alias("n")).drop("_run")


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of closed integer intervals (l_start, l_stop) and (r_start, r_stop) that overlap.

    Both sides are dealt to bins of `width`, so that an equi-join finds the pairs; a pair counts in
    the first bin that both touch only, so none comes twice.
    """

    def binned(frame: DataFrame, side: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col(f"{side}_start") / width), F.floor(F.col(f"{side}_stop") / width))
        return frame.withColumn("_bin", F.explode(bins))

    pairs = binned(left, "l").join(binned(right, "r"), [*keys, "_bin"])
    overlap = (F.col("l_start") <= F.col("r_stop")) & (F.col("r_start") <= F.col("l_stop"))
    first = F.floor(F.greatest("l_start", "r_start") / width) == F.col("_bin")
    return pairs.where(overlap & first).drop("_bin")


def in_ranges(start: Column, stop: Column, ranges: Column) -> Column:
    """Whether [start, stop] overlaps any struct (start, stop) of the array; no shuffle."""
    return F.exists(ranges, lambda r: (start <= r["stop"]) & (r["start"] <= stop))


def first_unit(line: Column, units: Column) -> Column:
    """The first struct (start, stop, ...) of the array that holds the line, else null."""
    return F.get(F.filter(units, lambda u: (u["start"] <= line) & (line <= u["stop"])), F.lit(0))


def diff_lines(patches: DataFrame, keys: list[str], patch: str = "patch") -> DataFrame:
    """(keys, hunk, pos, kind, old_line, new_line, text, context) of a unified diff's lines; kind is +, - or blank.

    Line numbers run on from the hunk's header; the marker for a missing last newline is no line. context is what the
    header says behind its ranges.
    """
    lines = patches.where(F.col(patch).isNotNull()).select(*keys, F.posexplode(F.split(patch, "\n")).alias("pos", "raw"))
    header = F.col("raw").rlike(r"^@@ -[0-9]+(?:,[0-9]+)? \+[0-9]+(?:,[0-9]+)? @@")
    number = lambda pattern: F.when(header, F.regexp_extract("raw", pattern, 1).cast("int"))
    so_far = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        lines.withColumn("_old", number(r"^@@ -([0-9]+)")).withColumn("_new", number(r"^@@ -[0-9]+(?:,[0-9]+)? \+([0-9]+)"))
        .withColumn("_context", F.when(header, F.regexp_extract("raw", r"^@@ [^@]* @@ ?(.*)$", 1)))
        .withColumn("hunk", F.sum(F.when(header, 1).otherwise(0)).over(so_far))
        .withColumn("kind", F.when(header | (F.col("hunk") == 0) | F.col("raw").startswith("\\") | (F.col("raw") == ""), None).otherwise(F.substring("raw", 1, 1)))
    )
    within = Window.partitionBy(*keys, "hunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    old_step = F.when(F.col("kind").isin("-", " "), 1).otherwise(0)
    new_step = F.when(F.col("kind").isin("+", " "), 1).otherwise(0)
    counted = marked.withColumn("old_line", F.first("_old", True).over(within) + F.sum(old_step).over(within) - 1).withColumn(
        "new_line", F.first("_new", True).over(within) + F.sum(new_step).over(within) - 1
    ).withColumn("context", F.first("_context", True).over(within))
    return counted.where("kind is not null").select(
        *keys, "hunk", "pos", "kind",
        F.when(F.col("kind") != "+", F.col("old_line")).alias("old_line"),
        F.when(F.col("kind") != "-", F.col("new_line")).alias("new_line"),
        F.expr("substring(raw, 2)").alias("text"), "context",
    )


def changed_ranges(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, start, stop, n): runs of removed (old) and added (new) lines."""
    changed = lines.select(
        *keys, F.inline(F.array(
            F.struct(F.lit("old").alias("side"), F.when(F.col("kind") == "-", F.col("old_line")).alias("line")),
            F.struct(F.lit("new").alias("side"), F.when(F.col("kind") == "+", F.col("new_line")).alias("line")),
        )),
    ).where("line is not null")
    return islands(changed, [*keys, "side"], "line")


def region_ends(frame: DataFrame, keys: list[str], start: str, last: str) -> DataFrame:
    """Adds stop: the line before the next start of the same key, for the last one the column `last`."""
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start)) - 1
    return frame.withColumn("stop", F.coalesce(following, F.col(last)))
