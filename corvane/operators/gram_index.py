"""A stored index of three-character strings, for substring and all-tokens search without reading all texts.

Segments are what single tasks have gathered, as in `text_index`; building shuffles nothing. A segment has, per string of three
characters, the sorted numbers of the rows whose lower-cased text has it, and the texts in blocks of BLOCK rows. A search
intersects the lists of all strings of its tokens, which leaves the rows that can match, reads the blocks of these alone and
tests them. Tokens of under three characters have no such strings; if no token has any, all blocks are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.search import haystack
from corvane.session import bounded_batches, checkpointed, shared_folder

#: Characters of text after which a segment is closed; rows of a block of texts; blocks that are looked up by name.
SEGMENT, BLOCK, FEW = 4_000_000, 32, 2000
_DDL = "segment string, term string, rows array<int>, first int, keys array<{key}>, texts array<string>, kind string"


def grams(text: str) -> set[str]:
    return {text[k : k + 3] for k in range(len(text) - 2)}


def _segment(keys: list, texts: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    name, lists = uuid.uuid4().hex, {}
    order = sorted(range(len(keys)), key=lambda k: (keys[k] is not None, keys[k]))
    keys, texts = [keys[k] for k in order], [texts[k] for k in order]
    for row, text in enumerate(texts):
        for gram in grams(text):
            lists.setdefault(gram, []).append(row)

    def batch(kind_name: str, terms=None, rows=None, first=None, own=None, held=None) -> pa.RecordBatch:
        size = len(terms if terms is not None else first)
        given = [("segment", pa.string(), [name] * size), ("term", pa.string(), terms), ("rows", pa.list_(pa.int32()), rows), ("first", pa.int32(), first), ("keys", pa.list_(kind), own), ("texts", pa.list_(pa.string()), held), ("kind", pa.string(), [kind_name] * size)]
        return pa.RecordBatch.from_arrays([pa.nulls(size, t) if v is None else pa.array(v, t) for _, t, v in given], names=[n for n, _, _ in given])

    terms = sorted(lists)
    for begin in range(0, len(terms), 5000):
        some = terms[begin : begin + 5000]
        yield batch("postings", some, [lists[t] for t in some])
    starts = list(range(0, len(keys), BLOCK))
    for begin in range(0, len(starts), 64):
        some = starts[begin : begin + 64]
        yield batch("texts", first=some, own=[keys[s : s + BLOCK] for s in some], held=[texts[s : s + BLOCK] for s in some])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, texts, size, kind = [], [], 0, None
    for batch in batches:
        kind = batch.schema.field("key").type
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            keys.append(key)
            texts.append(text)
            size += len(text)
            if size >= SEGMENT:
                yield from _segment(keys, texts, kind)
                keys, texts, size = [], [], 0
    if keys:
        yield from _segment(keys, texts, kind)


class GramIndex:
    """Built over some columns of a table; rows that repeat a key are rows of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, frame: DataFrame, key: str, columns: tuple[str, ...], path: str) -> GramIndex:
        spark, several = frame.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
        bounded_batches(spark)
        rows = frame.select(F.col(key).alias("key"), haystack(*columns).alias("text"))
        before = spark.conf.get(several)
        spark.conf.set(several, "8")
        try:
            made = rows.mapInArrow(_segments, _DDL.format(key=rows.schema["key"].dataType.simpleString()))
            made.write.mode("overwrite").option("parquet.block.size", 1 << 20).partitionBy("kind").parquet(path)
        finally:
            spark.conf.set(several, before)
        return cls(spark, path)

    def _kind(self, kind: str) -> DataFrame:
        try:
            whole = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            whole = self.spark.createDataFrame([], _DDL.format(key="string"))  # an empty table leaves no file
        return whole.where(F.col("kind") == kind)

    def candidates(self, tokens: list[str]) -> DataFrame | None:
        """(segment, first, at): rows that have all strings of all tokens; None if no token has any."""
        wanted = sorted(set().union(*map(grams, tokens)))
        if not wanted:
            return None

        def meet(own: pd.DataFrame) -> pd.DataFrame:
            if len(own) < len(wanted):
                rows = np.zeros(0, np.int64)
            else:
                lists = sorted(own["rows"], key=len)
                rows = lists[0]
                for other in lists[1:]:
                    rows = rows[np.isin(rows, other, assume_unique=True, kind="sort")]
            return pd.DataFrame({"segment": own["segment"].iloc[0], "first": rows - rows % BLOCK, "at": rows % BLOCK}, columns=["segment", "first", "at"])

        postings = self._kind("postings").where(F.col("term").isin(wanted)).select("segment", "rows")
        return postings.groupBy("segment").applyInPandas(meet, "segment string, first int, at int")

    def search(self, tokens: list[str], key: str, limit: int = -1) -> DataFrame:
        """(key) of the rows whose text has all tokens, in its order; a negative limit means all."""
        texts = self._kind("texts").select("segment", "first", "keys", "texts")
        held: Column = F.lit(True)
        for token in tokens:
            held = held & F.contains("text", F.lit(token))
        found = self.candidates(tokens)
        if found is None:
            rows = texts.select(F.inline(F.arrays_zip("keys", "texts"))).toDF("key", "text")
        else:
            found = checkpointed(found)
            few = found.select("segment", "first").distinct().limit(FEW + 1).collect()
            if len(few) <= FEW:
                texts = texts.where(F.col("segment").isin(sorted({r[0] for r in few})) & F.col("first").isin(sorted({r[1] for r in few})))
            rows = found.join(texts, ["segment", "first"]).select(F.expr("keys[at]").alias("key"), F.expr("texts[at]").alias("text"))
        met = rows.where(held).select(F.col("key").alias(key)).orderBy(key)
        return met if limit < 0 else met.limit(limit)


def index_of(frame: DataFrame, key: str, columns: tuple[str, ...], name: str) -> GramIndex:
    """The index that this application keeps of a table's columns under a name of its own, built at its first use."""
    spark = frame.sparkSession
    folder = f"{shared_folder(spark)}/gram-index-{spark.sparkContext.applicationId}-{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join((name, *columns))).hex}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        return GramIndex.build(frame, key, columns, folder)
    return GramIndex(spark, folder)
