"""Tables stored with a tree of hashes over ranges of their keys, so that a comparison reads the ranges that differ.

A row belongs to the leaf that the first DIGITS hexadecimal digits of its keys' hash name. A leaf's state is the sha256 over
its rows' hashes, as a multiset; that of every shorter prefix is the sha256 over the states below it, up to the root. The
rows lie in folders by the first two digits, sorted by leaf, and the tree beside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import checkpointed

#: Digits of a leaf, 16**DIGITS leaves at most, and of the folder it lies in.
DIGITS, FOLDER = 4, 2


def _row_hash(columns: list[str]) -> Column:
    """Of a row's values with their places; nulls differ from empty texts."""
    fields = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(columns))), {"ignoreNullFields": "false"})
    return F.sha2(fields.cast("binary"), 256)


def leaf_of(keys: list[str], digits: int = DIGITS) -> Column:
    return F.substring(_row_hash(keys), 1, digits)


def leaves(frame: DataFrame, keys: list[str], digits: int = DIGITS) -> DataFrame:
    """(prefix, state, n) of the leaves; equal rows are counted before they meet."""
    columns = list(frame.columns)
    hashed = frame.select(leaf_of(keys, digits).alias("prefix"), _row_hash(columns).alias("h")).groupBy("prefix", "h").agg(F.count("*").alias("n"))
    lines = F.array_sort(F.collect_list(F.concat_ws(":", "h", F.col("n").cast("string"))))
    return hashed.groupBy("prefix").agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("state"), F.sum("n").alias("n"))


def tree_of(below: DataFrame, digits: int = DIGITS) -> DataFrame:
    """(level, prefix, state, n) of all prefixes, the root being level 0, from the leaves."""
    level = checkpointed(below.select(F.lit(digits).alias("level"), "prefix", "state", "n"))  # 16**digits rows at most
    whole = level
    for number in range(digits - 1, -1, -1):
        lines = F.array_sort(F.collect_list(F.concat_ws(":", "prefix", "state")))
        parent = F.substring("prefix", 1, number) if number else F.lit("")
        level = level.groupBy(parent.alias("prefix")).agg(F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("state"), F.sum("n").alias("n"))
        level = level.select(F.lit(number).alias("level"), "prefix", "state", "n")
        whole = whole.unionByName(level)
    return whole


def store(frame: DataFrame, keys: list[str], path: str, digits: int = DIGITS) -> None:
    """Writes a table and its tree; `path` must be empty, or a table of this kind, which is replaced."""
    leaf = leaf_of(keys, digits)
    rows = frame.withColumn("_leaf", leaf).withColumn("_folder", F.substring(leaf, 1, FOLDER))
    rows.repartition("_folder").sortWithinPartitions("_folder", "_leaf").write.mode("overwrite").partitionBy("_folder").parquet(f"{path}/rows")
    tree_of(leaves(frame, keys, digits), digits).write.mode("overwrite").parquet(f"{path}/tree")


def stored_rows(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """The rows of a stored table, of some leaves alone if given: only their folders are listed and only their row groups read."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    if only is not None:
        rows = rows.where(F.col("_folder").isin(sorted({x[:FOLDER] for x in only})) & F.col("_leaf").isin(only))
    return rows.drop("_leaf", "_folder")


def differing(fresh: DataFrame, stored: DataFrame, digits: int = DIGITS) -> list[str]:
    """Leaves in which two trees differ, found from the root down: of a level only what lies below differing prefixes is compared."""
    found = [""]
    for level in range(digits + 1):
        parent = F.substring("prefix", 1, level - 1) if level > 1 else F.lit("")
        side = lambda t: t.where((F.col("level") == level) & (parent.isin(found) if level else F.lit(True))).select("prefix", "state")  # noqa: B023, E731
        a, b = side(fresh), side(stored)
        either = a.join(b.withColumnRenamed("state", "other"), "prefix", "full_outer").where(~F.col("state").eqNullSafe(F.col("other")))
        found = [r[0] for r in either.select("prefix").collect()]  # 16**level prefixes at most
        if not found:
            return []
    return found


def drift(expected: DataFrame, keys: list[str], path: str, digits: int = DIGITS) -> DataFrame:
    """The rows, as multisets, in which a table differs from the stored one, with the side that has them: missing or extra.

    The expected table is hashed once; of the stored one only its tree is read, and the rows of leaves that differ.
    """
    spark, columns = expected.sparkSession, expected.columns
    fresh = checkpointed(tree_of(leaves(expected, keys, digits), digits))
    leaf = differing(fresh, spark.read.parquet(f"{path}/tree"), digits)
    mine, theirs = expected.where(leaf_of(keys, digits).isin(leaf)), stored_rows(spark, path, leaf).select(columns)
    missing = mine.exceptAll(theirs).withColumn("side", F.lit("missing"))
    return missing.unionByName(theirs.exceptAll(mine).withColumn("side", F.lit("extra")))


def update(frame: DataFrame, keys: list[str], path: str, digits: int = DIGITS) -> int:
    """Brings the stored table to `frame` by rewriting the folders that differ; the number of these.

    A folder is replaced as a whole, its rows before the tree: if it stops between the two, the next update finds the
    same folders again.
    """
    spark = frame.sparkSession
    fresh = checkpointed(tree_of(leaves(frame, keys, digits), digits))
    folders = sorted({x[:FOLDER] for x in differing(fresh, spark.read.parquet(f"{path}/tree"), digits)})
    if folders:
        leaf = leaf_of(keys, digits)
        rows = frame.withColumn("_leaf", leaf).withColumn("_folder", F.substring(leaf, 1, FOLDER)).where(F.col("_folder").isin(folders))
        writer = rows.repartition("_folder").sortWithinPartitions("_folder", "_leaf").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_folder").parquet(f"{path}/rows")
        left = {r[0] for r in fresh.where(F.col("level") == FOLDER).select("prefix").collect()}  # 16**FOLDER at most
        for gone in (x for x in folders if x not in left):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows/_folder={gone}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        fresh.write.mode("overwrite").parquet(f"{path}/tree")
    return len(folders)
