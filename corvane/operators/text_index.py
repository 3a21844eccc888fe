"""A stored inverted index and block-max ranked search over it.

The index is a folder of Parquet files in three kinds of rows, each under its slice:

* `postings`: per segment and term the rows that have it, ascending, with frequencies, lengths and positions, and per
  block of BLOCK postings the largest frequency and the smallest length, which bound the score of the block whatever
  the corpus statistics are;
* `keys`: per segment, in blocks, the keys of its rows;
* `sizes`: per segment how many rows and tokens it has.

A segment is what one task has gathered of the rows that it reads, at most some SEGMENT tokens and in the order of their
keys; building is one map, nothing is shuffled, and a hot term is spread over all segments. Rows are sorted by term in
their files and row groups are small, so a search reads the postings of its own terms, by predicates that reach the scan.

A search takes the corpus statistics from `sizes` and from the counts of its terms, then each segment finds its own best
rows: the borders of the terms' blocks cut the segment into intervals, the sum of the block bounds tells the best score
that an interval can have, and intervals are scored from the highest bound down until it falls below the k-th best score.
Slices are replaced as a whole, so an index follows its table slice by slice.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.operators.search import B, CUT_OFF, K1, MIN_IDF, MIN_TERMS, phrases, word_tokens
from corvane.session import bounded_batches, checkpointed, shared_folder

#: Tokens after which a segment is closed; postings that share one bound; keys in one row.
SEGMENT, BLOCK, KEYS = 1_000_000, 128, 1024
ROW_GROUP_BYTES = 1 << 20
#: Up to that many rows of keys are looked up by name.
FEW = 1000
#: Identifiers that, named by a query, only rows whose key names them all can answer.
IDENTIFIER = r"(?i)\bCVE-\d{4}-\d+\b"

_INTS = pa.list_(pa.int32())
_FIELDS = [
    ("segment", pa.string()), ("term", pa.string()), ("first", pa.int32()), ("n", pa.int64()), ("total", pa.int64()),
    ("rows", _INTS), ("counts", _INTS), ("lengths", _INTS), ("most", _INTS), ("least", _INTS), ("positions", _INTS), ("keys", None), ("kind", pa.string()),
]
_DDL = (
    "segment string, term string, first int, n bigint, total bigint, rows array<int>, counts array<int>, lengths array<int>, "
    "most array<int>, least array<int>, positions array<int>, keys array<{key}>, kind string"
)


def _lists(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """values[cuts[k]:cuts[k + 1]] for every k."""
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))


def _segment(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    """The rows of one segment, from tables of (key, tokens)."""
    table = pa.concat_tables(tables).combine_chunks()
    order = pa.compute.sort_indices(table, sort_keys=[("key", "ascending")], null_placement="at_start")
    table = table.take(order).combine_chunks()
    keys, tokens = table.column("key").combine_chunks(), table.column("tokens").combine_chunks()
    name, kind = uuid.uuid4().hex, keys.type
    lengths = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = len(lengths)

    def batch(size: int, kind_name: str, **columns) -> pa.RecordBatch:
        arrays = []
        for field, t in _FIELDS:
            t = t or pa.list_(kind)
            value = {"segment": [name] * size, "kind": [kind_name] * size}.get(field, columns.get(field))
            arrays.append(pa.nulls(size, t) if value is None else value.cast(t) if isinstance(value, pa.Array) else pa.array(value, t))
        return pa.RecordBatch.from_arrays(arrays, names=[f for f, _ in _FIELDS])

    yield batch(1, "sizes", n=[rows], total=[int(lengths.sum())])
    starts = np.append(np.arange(0, rows, KEYS), rows)
    yield batch(len(starts) - 1, "keys", first=pa.array(starts[:-1]), n=pa.array(np.diff(starts)), keys=pa.ListArray.from_arrays(pa.array(starts, pa.int32()), keys))
    coded = tokens.flatten().dictionary_encode()
    words = coded.dictionary
    if not len(words):
        return
    by_word = pa.compute.sort_indices(words).to_numpy()
    rank = np.empty(len(words), np.int64)
    rank[by_word] = np.arange(len(words))
    term = rank[coded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(rows), lengths)
    place = np.arange(len(term)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    turn = np.argsort(term, kind="stable")
    term, row, place = term[turn], row[turn], place[turn]
    posting = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (row[1:] != row[:-1])))
    counts, of_term, row = np.diff(np.append(posting, len(term))), term[posting], row[posting]
    length = lengths[row]
    first = np.searchsorted(of_term, np.arange(len(words) + 1))
    within = np.arange(len(row)) - first[of_term]
    blocks = np.flatnonzero(within % BLOCK == 0)
    most, least = np.maximum.reduceat(counts, blocks), np.minimum.reduceat(length, blocks)
    block_cuts, token_cuts = np.searchsorted(blocks, first), np.append(posting, len(term))[first]
    ordered = words.take(pa.array(by_word))
    for begin in range(0, len(words), 20_000):
        end = min(begin + 20_000, len(words))
        some = slice(begin, end + 1)
        yield batch(
            end - begin, "postings", term=ordered.slice(begin, end - begin), n=pa.array(np.diff(first[some])),
            rows=_lists(row, first[some]), counts=_lists(counts, first[some]), lengths=_lists(length, first[some]),
            most=_lists(most, block_cuts[some]), least=_lists(least, block_cuts[some]), positions=_lists(place, token_cuts[some]),
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.Table] = []
    size = 0
    for batch in batches:
        waiting.append(pa.Table.from_batches([batch]))
        size += len(batch.column("tokens").flatten())
        if size >= SEGMENT:
            yield from _segment(waiting)
            waiting, size = [], 0
    if sum(t.num_rows for t in waiting):
        yield from _segment(waiting)


def upsert(frame: DataFrame, key: str, text: str, path: str, part: str = "all") -> None:
    """Writes the slice `part` of the index at `path` from the rows of `frame`, in place of what that slice had.

    Null and empty texts are rows without tokens; null keys come first; rows that repeat a key are rows of their own.
    """
    bounded_batches(frame.sparkSession)
    tokens = word_tokens(F.col(text)).cast("array<string>").alias("tokens")
    rows = frame.select(F.col(key).alias("key"), tokens)
    made = rows.mapInArrow(_segments, _DDL.format(key=rows.schema["key"].dataType.simpleString()))
    sliced = made.withColumn("slice", F.lit(part))
    spark, several = frame.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(several)
    spark.conf.set(several, "8")  # a task's three kinds of rows go to files side by side, without a sort
    writer = sliced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", ROW_GROUP_BYTES)
    try:
        writer.partitionBy("slice", "kind").parquet(path)
    finally:
        spark.conf.set(several, before)


def _phrase(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, counts, lengths) of the rows where the terms follow each other; occurrences don't overlap. parts: rows, counts, lengths, positions."""
    rows, _, lengths, _ = parts[0]
    for other, *_ in parts[1:]:
        rows = rows[np.isin(rows, other, assume_unique=True)]
    starts = []
    for number, (own, counts, _, positions) in enumerate(parts):
        at = np.repeat(own, counts)
        keep = np.isin(at, rows)
        starts.append((at[keep].astype(np.int64) << 32) + positions[keep] - number)
    met = starts[0]
    for other in starts[1:]:
        met = np.intersect1d(met, other, assume_unique=True)
    met.sort()
    taken, row, end = [], -1, 0
    for start in met.tolist():
        if start >> 32 != row or start >= end:
            row, end = start >> 32, start + len(parts)
            taken.append(row)
    found, counts = np.unique(np.array(taken, np.int64), return_counts=True)
    return found, counts, lengths[np.searchsorted(parts[0][0], found)]


def _lists_of(own: pd.DataFrame, terms: list[list[str]]) -> list[tuple[np.ndarray, ...] | None]:
    """Per query term (rows, counts, lengths, most, least) in a segment, None where it has none."""
    stored = {r.term: r for r in own.itertuples()}
    found: list[tuple[np.ndarray, ...] | None] = []
    for phrase in terms:
        if any(t not in stored for t in phrase):
            found.append(None)
        elif len(phrase) == 1:
            r = stored[phrase[0]]
            found.append((r.rows, r.counts, r.lengths, r.most, r.least))
        else:
            rows, counts, lengths = _phrase([(stored[t].rows, stored[t].counts, stored[t].lengths, stored[t].positions) for t in phrase])
            blocks = np.arange(0, len(rows), BLOCK)
            found.append((rows, counts, lengths, np.maximum.reduceat(counts, blocks), np.minimum.reduceat(lengths, blocks)) if len(rows) else None)
    return found


def _part(weight: float, count, length, average: float):
    return weight * count * (K1 + 1) / (count + K1 * ((1 - B) + B * length / average))


def best_rows(lists: list[tuple[np.ndarray, ...] | None], weights: list[float], average: float, limit: int, cut_off: float, min_terms: int) -> tuple[list[tuple[float, int, int]], int]:
    """((score, terms, row) of the best rows of a segment, best first; how many postings were scored).

    Lower scores are better, ties go to the smaller row; rows of under `min_terms` terms need the cut-off.
    """
    present = [(k, x) for k, x in enumerate(lists) if x is not None]
    borders = np.unique(np.concatenate([x[0][::BLOCK] for _, x in present])) if present else np.zeros(0, np.int64)
    bounds = np.zeros(len(borders))
    for k, (rows, _, _, most, least) in present:
        block = np.searchsorted(rows[::BLOCK], borders, "right") - 1  # the block that an interval lies in
        inside = (block >= 0) & (rows[np.minimum((block + 1) * BLOCK, len(rows)) - 1] >= borders)
        bounds += np.where(inside, _part(weights[k], most[block].astype(float), least[block].astype(float), average), 0.0)
    ends = np.append(borders[1:], np.iinfo(np.int64).max)
    best: list[tuple[float, int, int]] = []
    scored = 0
    for turn in np.argsort(-bounds, kind="stable"):
        if len(best) >= limit and -bounds[turn] * (1 + 1e-9) > best[-1][0]:
            break
        low, high = borders[turn], ends[turn]
        spans = [(k, x, *np.searchsorted(x[0], (low, high))) for k, x in present]
        here = np.unique(np.concatenate([x[0][a:b] for _, x, a, b in spans]))
        total, terms = np.zeros(len(here)), np.zeros(len(here), np.int64)
        for k, (rows, counts, lengths, *_), a, b in spans:
            at = np.searchsorted(here, rows[a:b])
            total[at] += _part(weights[k], counts[a:b].astype(float), lengths[a:b].astype(float), average)
            terms[at] += 1
            scored += int(b - a)
        keep = (terms >= min_terms) | (-total <= cut_off)
        best = sorted([*best, *zip((-total[keep]).tolist(), terms[keep].tolist(), here[keep].tolist(), strict=True)], key=lambda x: (x[0], x[2]))[:limit]
    return best, scored


class TextIndex:
    """Searches the index in a folder; slices that are upserted later are seen."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _kind(self, kind: str) -> DataFrame:
        try:
            whole = self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            whole = self.spark.createDataFrame([], _DDL.format(key="string"))  # an empty table leaves no file
        return whole.where(F.col("kind") == kind)

    def postings(self, terms: list[list[str]], positions: bool | None = None) -> DataFrame:
        """The stored postings of the query's terms; positions only where a term is a phrase."""
        wanted = sorted({t for phrase in terms for t in phrase})
        columns = ["segment", "term", "n", "rows", "counts", "lengths", "most", "least"]
        if positions if positions is not None else any(len(p) > 1 for p in terms):
            columns.append("positions")
        return self._kind("postings").where(F.col("term").isin(wanted)).select(*columns)

    def _statistics(self, terms: list[list[str]]) -> tuple[int, float, list[int]]:
        """(rows of the corpus, tokens of a row, rows that each term matches)."""
        n, total = self._kind("sizes").agg(F.sum("n"), F.sum("total")).first()
        plain = {t for p in terms if len(p) == 1 for t in p}
        df = dict(self._kind("postings").where(F.col("term").isin(sorted(plain))).groupBy("term").agg(F.sum("n")).collect()) if plain else {}
        several = [k for k, p in enumerate(terms) if len(p) > 1]
        if several:

            def count(own: pd.DataFrame) -> pd.DataFrame:
                lists = _lists_of(own, terms)
                return pd.DataFrame([(k, len(lists[k][0])) for k in several if lists[k] is not None], columns=["k", "n"])

            met = self.postings(terms).groupBy("segment").applyInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n")).collect()
            of_phrase = dict(met)
        return n or 0, (total or 0) / n if n else 0.0, [of_phrase.get(k, 0) if len(p) > 1 else df.get(p[0], 0) for k, p in enumerate(terms)]

    def search(self, query: str, limit: int = 10, cut_off: float = CUT_OFF, min_terms: int = MIN_TERMS, key: str = "key", identifier: str | None = None) -> DataFrame:
        """(key, score, terms) as `operators.search.bm25` gives, best first, or nothing.

        `identifier` is the pattern of exact ids (e.g. IDENTIFIER): a query that names any is answered by the rows whose key
        names them all, with score 0 and in the order of their keys, and by no other.
        """
        kind = self._kind("keys").schema["keys"].dataType.elementType
        names = f"{key} {kind.simpleString()}, score double, terms bigint"
        ids = sorted({x.upper() for x in re.findall(identifier, query)}) if identifier else []
        if ids:
            keys = self._kind("keys").select(F.explode("keys").alias(key))
            own = F.transform(F.regexp_extract_all(F.col(key).cast("string"), F.lit(identifier), F.lit(0)), F.upper)
            exact = keys.where(F.size(F.array_except(F.array(*map(F.lit, ids)), own)) == 0)
            return exact.select(key, F.lit(0.0).alias("score"), F.lit(len(ids)).cast("long").alias("terms")).orderBy(key).limit(limit)
        terms = phrases(query)
        nothing = self.spark.createDataFrame([], names)
        if not terms:
            return nothing
        n, average, df = self._statistics(terms)
        if not n or not any(df):
            return nothing
        idf = [np.log((n - d + 0.5) / (d + 0.5)) for d in df]
        weights = [float(x) if x > 0 else MIN_IDF for x in idf]

        def find(own: pd.DataFrame) -> pd.DataFrame:
            best, _ = best_rows(_lists_of(own, terms), weights, average, limit, cut_off, min_terms)
            return pd.DataFrame([(own["segment"].iloc[0], row - row % KEYS, row % KEYS, score, t) for score, t, row in best], columns=["segment", "first", "at", "score", "terms"])

        found = self.postings(terms).groupBy("segment").applyInPandas(find, "segment string, first int, at int, score double, terms long")
        best = Window.orderBy("score")
        best = checkpointed(found.withColumn("place", F.rank().over(best)).where(F.col("place") <= limit).drop("place"))
        return self._named(best, key).orderBy("score", key).limit(limit)

    def _named(self, best: DataFrame, key: str) -> DataFrame:
        """Keys in place of places; of few segments only their own rows of keys are read."""
        keys = self._kind("keys").select("segment", "first", "keys")
        few = best.select("segment", "first").distinct().limit(FEW + 1).collect()
        if len(few) <= FEW:
            keys = keys.where(F.col("segment").isin([r[0] for r in few]) & F.col("first").isin([r[1] for r in few]))
        return best.join(keys, ["segment", "first"]).select(F.expr("keys[at]").alias(key), "score", "terms")

    def matches(self, query: str) -> DataFrame:
        """(term, segments, rows, bytes): what a search of the query reads, by term."""
        size = 4 * (F.size("rows") + F.size("counts") + F.size("lengths") + F.size("most") + F.size("least"))
        return self.postings(phrases(query)).groupBy("term").agg(F.count("*").alias("segments"), F.sum("n").alias("rows"), F.sum(size).cast("long").alias("bytes"))


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/text-index-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def index_of(frame: DataFrame, key: str, text: str, name: str) -> TextIndex:
    """The index that this application keeps of a table under a name of its own, built at its first use."""
    spark = frame.sparkSession
    folder = f"{shared_folder(spark)}/text-index-{spark.sparkContext.applicationId}-{uuid.uuid5(uuid.NAMESPACE_URL, name).hex}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        upsert(frame, key, text, folder)
    return TextIndex(spark, folder)
