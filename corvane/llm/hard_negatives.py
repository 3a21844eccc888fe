"""Hard negatives by product quantisation with stored residual norms.

Vectors become integers; a score is their exact integer inner product. Every vector is stored with the codes of
its product quantiser, parts of SUB components with at most ENTRIES integer entries each, and the norm of what the
quantiser leaves over. For an anchor, one lookup per part gives the score of the quantised vector, and
|score - looked up| <= |anchor| * residual norm (Cauchy-Schwarz), so each vector has a rigorous interval for its score:

* positives: of the anchor's label, those whose upper bound reaches the k-th best lower bound get exact scores;
* negatives: of the other labels, those whose interval meets a window [80 % of a positive's score, that score] and whose
  upper bound reaches the k-th best lower bound of vectors surely inside it get exact scores and fill the window.

Quantiser and codes only decide how many vectors are scored exactly, never which rows come out. The quantiser is
fitted on the FIT_ROWS vectors with the smallest hashes of their ids. Anchors go out in blocks of some ANCHORS, and each
block makes two passes over the stored codes, one task handing on at most k rows per anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.integer_vectors import integer_matrix, longest, whole_vectors
from corvane.session import checkpointed
from corvane.sources.tables import table

FACTOR, EVERY, WANTED = 256, 100, 5
#: A negative's score is between so many hundredths of its positive's and that score.
SHARE = 80
#: Components of a part, entries per part, vectors that the quantiser is fitted on, rounds of fitting.
SUB, ENTRIES, FIT_ROWS, FIT_ROUNDS = 2, 256, 4096, 6
#: Anchors of one block, about: some 2 MB that every worker holds.
ANCHORS = 3000


class Quantiser:
    """Integer entries per part; the last part is filled with zeros."""

    def __init__(self, sample: np.ndarray, sub: int = SUB, entries: int = ENTRIES, rounds: int = FIT_ROUNDS):
        self.dim = sample.shape[1]
        self.sub, self.parts = sub, max(1, -(-self.dim // sub))
        cut = self._cut(sample).astype(np.float64)
        step = max(1, len(sample) // entries)
        self.books = np.zeros((self.parts, min(entries, len(sample)), sub), np.int64)
        for p in range(self.parts):
            own = cut[:, p]
            book = own[np.lexsort(own.T)][::step][: self.books.shape[1]]
            for _ in range(rounds):
                near = self._nearest(own, book)
                counts = np.bincount(near, minlength=len(book))
                sums = np.column_stack([np.bincount(near, own[:, k], len(book)) for k in range(sub)])
                book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
            self.books[p, : len(book)] = np.rint(book)

    def _cut(self, vectors: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(vectors), self.parts * self.sub), np.int64)
        padded[:, : self.dim] = vectors
        return padded.reshape(len(vectors), self.parts, self.sub)

    @staticmethod
    def _nearest(own: np.ndarray, book: np.ndarray) -> np.ndarray:
        near = np.empty(len(own), np.int64)
        for begin in range(0, len(own), 4096):
            part = own[begin : begin + 4096]
            near[begin : begin + 4096] = sum((part[:, k, None] - book[:, k]) ** 2 for k in range(own.shape[1])).argmin(axis=1)
        return near

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """((n, parts) codes, norms of the residuals)."""
        cut = self._cut(vectors)
        codes = np.column_stack([self._nearest(cut[:, p].astype(np.float64), self.books[p].astype(np.float64)) for p in range(self.parts)])
        left = cut - self.books[np.arange(self.parts), codes]
        return codes.astype(np.uint8), np.sqrt((left.astype(np.float64) ** 2).sum(axis=(1, 2)))

    def table(self, anchor: np.ndarray) -> np.ndarray:
        """(parts, entries): what each entry adds to the anchor's score."""
        return np.einsum("pes,ps->pe", self.books, self._cut(anchor[None])[0])


def scores(lookup: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Scores of quantised vectors; `codes` has a row per part."""
    total = np.zeros(codes.shape[1], np.int64)
    for entry, code in zip(lookup, codes, strict=True):
        total += entry[code]
    return total


def _stored(quantiser: Quantiser, factor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = integer_matrix(batch.column("embedding"), factor, quantiser.dim)
            codes, residual = quantiser.encode(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([v.tobytes() for v in vectors.astype("<i4")], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(residual)],
                names=["vec_id", "label", "vector", "code", "residual"],
            )

    return run


class _Rows:
    """A batch of stored rows, sorted by label."""

    def __init__(self, batch: pa.RecordBatch, parts: int):
        labels = batch.column("label").to_numpy()
        turn = np.argsort(labels, kind="stable")
        self.labels, self.ids = labels[turn], batch.column("vec_id").to_numpy()[turn]
        self.residual = batch.column("residual").to_numpy()[turn]
        read = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(len(turn), -1)[turn]
        self.vectors = read("vector", "<i4").astype(np.int64)
        self.codes = np.ascontiguousarray(read("code", np.uint8).reshape(len(turn), parts).T)

    def bounds(self, lookup: np.ndarray, norm: float, own: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of the rows of a slice."""
        middle = scores(lookup, self.codes[:, own])
        apart = np.ceil(self.residual[own] * norm * (1 + 1e-9)).astype(np.int64) + 1
        return middle - apart, middle + apart

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, "right"))


def _best(found: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The first k (score, id): higher scores first, ties by smaller id."""
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def _kth(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _positives(quantiser: Quantiser, anchors: list[tuple[int, int, np.ndarray]], k: int):
    """(anchor, score, id): per task the best k other rows of each anchor's label. anchors: (id, label, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in anchors]
        for batch in batches:
            rows = _Rows(batch, quantiser.parts)
            for number, (name, label, vector) in enumerate(anchors):
                low, high = rows.of_label(label)
                if low == high:
                    continue
                own = slice(low, high)
                lower, upper = rows.bounds(quantiser.table(vector), float(np.sqrt((vector**2).sum())), own)
                other = rows.ids[own] != name
                floor = _kth(lower[other], k)
                floor = max((x for x in (floor, best[number][-1][0] if len(best[number]) == k else None) if x is not None), default=None)
                at = np.flatnonzero(other if floor is None else other & (upper >= floor)) + low
                exact = rows.vectors[at] @ vector
                best[number] = _best(best[number] + list(zip(exact.tolist(), rows.ids[at].tolist(), strict=True)), k)
        found = [(n, s, i) for n, pairs in enumerate(best) for s, i in pairs]
        yield _batch(found, ("anchor", "score", "id"))

    return run


def _batch(rows: list[tuple[int, ...]], names: tuple[str, ...]) -> pa.RecordBatch:
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list(names))


def _negatives(quantiser: Quantiser, anchors: list[tuple[int, int, np.ndarray]], windows: list[list[tuple[int, int, int]]], k: int):
    """(anchor, positive, score, id): per task the best k rows of other labels in each window (positive, lowest, highest score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for batch in batches:
            rows = _Rows(batch, quantiser.parts)
            for number, (name, label, vector) in enumerate(anchors):
                if not windows[number]:
                    continue
                lookup, norm = quantiser.table(vector), float(np.sqrt((vector**2).sum()))
                low, high = rows.of_label(label)
                for own in (slice(0, low), slice(high, len(rows.ids))):
                    if own.start == own.stop:
                        continue
                    lower, upper = rows.bounds(lookup, norm, own)
                    other = rows.ids[own] != name
                    take = np.zeros(len(lower), bool)
                    for positive, lowest, highest in windows[number]:
                        here = best.get((number, positive), [])
                        floor = _kth(lower[other & (lower >= lowest) & (upper <= highest)], k)
                        floor = max(x for x in (lowest, floor, here[-1][0] if len(here) == k else None) if x is not None)
                        take |= other & (upper >= floor) & (lower <= highest)
                    at = np.flatnonzero(take) + own.start
                    if not len(at):
                        continue
                    exact, ids = rows.vectors[at] @ vector, rows.ids[at]
                    for positive, lowest, highest in windows[number]:
                        inside = (exact >= lowest) & (exact <= highest)
                        if inside.any():
                            more = list(zip(exact[inside].tolist(), ids[inside].tolist(), strict=True))
                            best[number, positive] = _best(best.get((number, positive), []) + more, k)
        found = [(n, p, s, i) for (n, p), pairs in best.items() for s, i in pairs]
        yield _batch(found, ("anchor", "positive", "score", "id"))

    return run


def _first(frame: DataFrame, *keys: str, k: int) -> DataFrame:
    """The first k rows per key with their rank; every task hands on k of each at most."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window_of(score: int, share: int = SHARE) -> tuple[int, int]:
    """Lowest and highest negative score: share * score <= 100 * n <= 100 * score; no n where the score is negative."""
    return -(-share * score // 100), score


def stored_rows(embeddings: DataFrame, factor: int = FACTOR, fit_rows: int = FIT_ROWS) -> tuple[DataFrame, Quantiser | None]:
    """(vec_id, label, vector, code, residual; the quantiser) of the rows that take part, labels of every seventh id moved on."""
    rows = whole_vectors(embeddings, factor).where("vec_id is not null and label is not null")
    label = F.col("label").cast("long")
    rows = rows.select("vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding")
    dim = longest(rows)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(fit_rows).select("embedding").collect()
    if not sample:
        return rows.select("vec_id", "label"), None
    quantiser = Quantiser(integer_matrix(pa.array([list(r[0]) for r in sample], pa.list_(pa.float64())), factor, max(1, dim)))
    schema = "vec_id long, label long, vector binary, code binary, residual double"
    return rows.mapInArrow(_stored(quantiser, factor), schema), quantiser


def hard_negatives(embeddings: DataFrame, every: int = EVERY, wanted: int = WANTED, share: int = SHARE, factor: int = FACTOR, block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every anchor, positive and negative.

    Rows with a null id, label or vector, with a null or non-finite component, or with one too large for exact longs
    (`whole_vectors`) take no part. Vectors of other lengths count as if zeros followed. Rows that repeat an id are rows
    of their own, but never partners of their own id; an anchor that repeats is taken once per label and vector. Ties go to
    the smaller id. Positives of a negative score have no negatives. An empty table gives an empty one.
    """
    spark = embeddings.sparkSession
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    stored, quantiser = stored_rows(embeddings, factor)
    if quantiser is None:
        return spark.createDataFrame([], names)
    stored = checkpointed(stored)
    anchors = stored.where(F.col("vec_id") % every == 0).select("vec_id", "label", "vector").distinct()
    blocks = max(1, -(-anchors.count() // block))
    result = spark.createDataFrame([], names)
    for number in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).orderBy("vec_id", "label", "vector").collect()  # about `block` rows
        queries = [(r[0], r[1], np.frombuffer(r[2], "<i4").astype(np.int64)) for r in own]
        near = stored.mapInArrow(_positives(quantiser, queries, wanted), "anchor long, score long, id long")
        positives = _first(near, "anchor", k=wanted).select("anchor", F.col("rank").alias("positive"), "id", "score").collect()
        windows: list[list[tuple[int, int, int]]] = [[] for _ in queries]
        for anchor, positive, _, score in positives:  # wanted of each query at most
            if score >= 0:
                windows[anchor].append((positive, *window_of(score, share)))
        pairs = [(a, p, queries[a][0], i, s) for a, p, i, s in positives]
        named = spark.createDataFrame(pairs, "anchor long, positive long, anchor_id long, positive_id long, positive_score long")
        found = stored.mapInArrow(_negatives(quantiser, queries, windows, wanted), "anchor long, positive long, score long, id long")
        ranked = _first(found, "anchor", "positive", k=wanted).join(F.broadcast(named), ["anchor", "positive"])
        rows = ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        result = result.unionByName(checkpointed(rows)) if blocks > 1 else rows
    return result


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


SQL = """
WITH kept AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS MATERIALIZED (SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM scored WHERE same) WHERE k <= 5)
SELECT anchor_id, positive_id, CAST(k AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score FROM (
  SELECT p.*, s.id, s.score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS k
  FROM positive p JOIN scored s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score) WHERE k <= 5
"""
