"""Deterministic sinks: canonical JSON, sharded entities, swaps, SQL text, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def _sorted_value(value: Column, kind: DataType) -> Column:
    """The value with the fields of its structs and the keys of its maps in order, at every depth."""
    if isinstance(kind, StructType):
        fields = [_sorted_value(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _sorted_value(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.transform(F.map_keys(value), lambda k: F.struct(k.alias("key"))))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _sorted_value(value[e["key"]], kind.valueType).alias("value"))))
    return value


def canonical_column(frame: DataFrame) -> Column:
    """JSON of a row with sorted fields and sorted map keys, nested ones too; nulls stay."""
    fields = [_sorted_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(frame.schema.fields, key=lambda f: f.name)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_jsonl(frame: DataFrame, path: str, order: list[str]) -> None:
    """Canonical JSON lines, ordered over all files."""
    frame.orderBy(*order).select(canonical_column(frame).alias("value")).write.mode("overwrite").text(path)


def write_entities(frame: DataFrame, path: str, shard: str, order: list[str], parts: int = 4) -> None:
    """One folder for each value of `shard`, rows sorted within a file; readers prune by it.

    A shard is dealt over `parts` tasks by the hash of its order columns, so a hot one is not a task's alone.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(parts))
    frame.repartition(shard, part).sortWithinPartitions(shard, *order).write.mode("overwrite").partitionBy(shard).json(path)


def swap(frame: DataFrame, path: str) -> None:
    """Writes Parquet beside a table and moves it in place by renames of the store.

    The old table is there until the new one is whole. What a crash between the renames leaves aside is put back
    first, and so it is if the second rename fails.
    """
    spark = frame.sparkSession
    jvm = spark._jvm
    frame.write.mode("overwrite").parquet(path + ".new")
    here, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, path + ".new", path + ".old"))
    store = here.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if store.exists(old) and not store.exists(here):
        store.rename(old, here)
    store.delete(old, True)
    if store.exists(here):
        store.rename(here, old)
    if not store.rename(new, here):
        store.rename(old, here)
        raise OSError(f"{path}: the new table could not be moved in place")
    store.delete(old, True)


def swap_in_order(tables: list[tuple[DataFrame, str]]) -> None:
    """Swaps several tables one after the other, those that others point to first: a catalog before its index."""
    for frame, path in tables:
        swap(frame, path)


def write_if_changed(frame: DataFrame, path: str) -> bool:
    """Replaces a Parquet table only if rows differ, as multisets; True if it wrote."""
    spark = frame.sparkSession
    try:
        stored = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = None
    if stored is not None and sorted(stored.columns) == sorted(frame.columns):
        stored = stored.select(frame.columns)
        if frame.exceptAll(stored).isEmpty() and stored.exceptAll(frame).isEmpty():
            return False
    swap(frame, path)
    return True


def insert_statements(frame: DataFrame, name: str) -> DataFrame:
    """(value): an INSERT for each row; strings quoted, nulls as NULL, other types by their text, arrays and structs as JSON."""

    def literal(field) -> Column:
        column, kind = F.col(f"`{field.name}`"), field.dataType.typeName()
        if kind in ("array", "struct", "map"):
            column, kind = F.to_json(column), "string"
        text = column.cast("string")
        if kind not in ("byte", "short", "integer", "long", "float", "double", "decimal", "boolean"):
            text = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    values = F.concat_ws(", ", *(literal(f) for f in frame.schema.fields))
    return frame.select(F.concat(F.lit(f"INSERT INTO {name} VALUES ("), values, F.lit(");")).alias("value"))


def manifest(spark, root: str) -> DataFrame:
    """(path, sha256, bytes) of all files below a folder, by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    relative = F.regexp_replace(F.col("path"), "^.*?" + "\\Q" + root.rstrip("/") + "\\E/", "")
    return files.select(relative.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes")).orderBy("path")


def markdown(frame: DataFrame, title: str, most: int = 200) -> str:
    """A report table of the first `most` rows of an ordered result."""
    rows = frame.limit(most).collect()  # a report
    clean = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(frame.columns) + " |", "|" + "---|" * len(frame.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(clean, r)) + " |" for r in rows)]) + "\n"
