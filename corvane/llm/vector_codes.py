"""Product codes of vectors with codebooks that are reproducible to the last digit.

Vectors become integers and are cut into PARTS equal parts. Each part position has a codebook of at most ENTRIES
integer entries, which ROUNDS rounds of k-means refine: a round assigns every part of every vector in one map
and brings back sums and counts per entry, a table of fixed size. So the rounds are exact: no sum depends on
an order of rows.

The nearest entry is found by segment means. A part is cut into 1, 2, 4, ... blocks; with the means of the blocks
and the norm of what is left, |x - c|^2 is at least the sum of size * (mean_x - mean_c)^2 over the blocks plus
(rest_x - rest_c)^2. Entries whose bound at a coarse level exceeds the distance of the best guess so far are
dropped before the next finer one, and the survivors get exact integer distances. Bounds are lowered by more than
rounding can add, so no entry is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.integer_vectors import integer_matrix, longest, whole_vectors
from corvane.session import checkpointed
from corvane.sources.tables import table

FACTOR, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors that are compared with a codebook at a time.
ROWS = 2048
#: Labels up to this number have their sums broadcast; with more, the join shuffles.
BROADCAST_LABELS = 10_000


def sketches(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, coarse to fine: ((n, blocks) means times the root of the block's size, norms of what is left)."""
    size, levels, blocks = vectors.shape[1], [], 1
    while blocks < size:
        edges = [size * k // blocks for k in range(blocks + 1)]
        sizes = np.diff(edges)
        means = np.add.reduceat(vectors, edges[:-1], axis=1) / sizes
        rest = vectors - np.repeat(means, sizes, axis=1)
        levels.append((means * np.sqrt(sizes), np.sqrt((rest * rest).sum(axis=1))))
        blocks *= 2
    return levels


def _lowered(bounds: np.ndarray) -> np.ndarray:
    return bounds * (1 - 1e-9) - 1e-3


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, the lower of equal ones; squared distance) of every row, both exact."""
    index, distance = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64)
    of_entries = sketches(entries)
    for begin in range(0, len(vectors), ROWS):
        part = vectors[begin : begin + ROWS]
        best, least = _nearest(part, entries, sketches(part), of_entries)
        index[begin : begin + ROWS], distance[begin : begin + ROWS] = best, least
    return index, distance


def _nearest(rows, entries, of_rows, of_entries) -> tuple[np.ndarray, np.ndarray]:
    def exact(row, entry):
        apart = rows[row] - entries[entry]
        return (apart * apart).sum(axis=1)

    row, entry = (x.ravel() for x in np.indices((len(rows), len(entries))))
    limit = np.full(len(rows), np.iinfo(np.int64).max)
    for level, ((means, rest), (entry_means, entry_rest)) in enumerate(zip(of_rows, of_entries, strict=True)):
        if level == 0:  # all pairs, as a matrix
            bound = ((means - entry_means.T) ** 2 + (rest[:, None] - entry_rest) ** 2).ravel()
        else:
            bound = (rest[row] - entry_rest[entry]) ** 2
            for k in range(means.shape[1]):
                bound += (means[row, k] - entry_means[entry, k]) ** 2
        cuts = np.searchsorted(row, np.arange(len(rows)))
        lowest = np.minimum.reduceat(bound, cuts)
        first = np.flatnonzero(bound == lowest[row])
        guess = first[np.searchsorted(row[first], np.arange(len(rows)))]  # the entry of the lowest bound of each row
        limit = np.minimum(limit, exact(row[guess], entry[guess]))
        keep = _lowered(bound) <= limit[row]
        row, entry = row[keep], entry[keep]
    found = exact(row, entry)
    cuts = np.searchsorted(row, np.arange(len(rows)))
    least = np.minimum.reduceat(found, cuts)
    first = np.flatnonzero(found == least[row])
    return entry[first[np.searchsorted(row[first], np.arange(len(rows)))]], least


def _sums(books: np.ndarray, factor: int):
    """(slot, total): sums of the components and counts of the vectors at every entry, slots in the order of `_moved`."""
    parts, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, size + 1), np.int64)
        for batch in batches:
            vectors = integer_matrix(batch.column("embedding"), factor, parts * size)
            for p in range(parts):
                own = vectors[:, p * size : (p + 1) * size]
                at, _ = nearest(own, books[p])
                np.add.at(totals[p], at, np.column_stack((own, np.ones(len(own), np.int64))))
        slots = np.flatnonzero(totals.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(totals.ravel()[slots])], names=["slot", "total"])

    return run


def _moved(books: np.ndarray, sums: list[tuple[int, int]]) -> np.ndarray:
    """The entries at the floors of their means; those without vectors stay."""
    totals = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    for slot, total in sums:
        totals.ravel()[slot] = total
    counts = totals[:, :, -1:]
    return np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), books)


def _coded(books: np.ndarray, factor: int):
    parts, _, size = books.shape
    kinds = pa.int64(), None, pa.string(), pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = integer_matrix(batch.column("embedding"), factor, parts * size)
            found = [nearest(vectors[:, p * size : (p + 1) * size], books[p]) for p in range(parts)]
            codes = np.column_stack([at for at, _ in found]).astype(np.uint8)
            error = sum(distance for _, distance in found)
            columns = [batch.column("vec_id"), batch.column("label"), [c.tobytes().hex() for c in codes], error]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "code", "error"])

    return run


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR) -> np.ndarray:
    """(parts, entries, components) of longs; `rows` as of `whole_vectors`. Fewer vectors than `entries` give fewer entries."""
    size = max(1, -(-longest(rows) // parts))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    if not first:
        return np.zeros((parts, 0, size), np.int64)
    seeds = integer_matrix(pa.array([list(r[0]) for r in first], pa.list_(pa.float64())), factor, parts * size)
    books = seeds.reshape(len(seeds), parts, size).swapaxes(0, 1).copy()
    for _ in range(rounds):
        sums = rows.select("embedding").mapInArrow(_sums(books, factor), "slot long, total long")
        books = _moved(books, sums.groupBy("slot").agg(F.sum("total")).collect())  # parts * entries * (size + 1) rows at most
    return books


def encode(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row with a whole, finite vector.

    Repeated rows each count; a null id is kept and comes last among the seeds, rows of one id are seeds in the order
    of their vectors; null labels are one label. Vectors of other lengths count as if zeros followed up to the longest,
    and up to a multiple of `parts`; components too large for exact longs take their row out (`whole_vectors`). An
    empty table, or one without such rows, gives an empty one. At most 256 entries fit two hex digits.
    """
    rows = whole_vectors(embeddings, factor)
    books = codebooks(rows, parts, entries, rounds, factor)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    label = rows.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, code string, error long"
    if not books.size:
        coded = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        coded = rows.mapInArrow(_coded(books, factor), schema)
    coded = checkpointed(coded)
    errors = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("of"), "label_error")
    if errors.count() <= BROADCAST_LABELS:
        errors = F.broadcast(errors)
    joined = coded.join(errors, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same in SQL: the rounds one after the other as common table expressions."""
    apart = "list_sum(list_transform(list_zip(v.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"

    def assigned(number: int) -> str:
        return (
            f"a{number} AS MATERIALIZED (SELECT vec_id, label, part, x, entry, d FROM (SELECT v.vec_id, v.label, v.part, v.x, b.entry, {apart} AS d, "
            f"row_number() OVER (PARTITION BY v.vec_id, v.part ORDER BY {apart}, b.entry) AS k FROM cut v JOIN b{number} b USING (part)) WHERE k = 1)"
        )

    def moved(number: int) -> str:
        return (
            f"b{number + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{number} b LEFT JOIN (SELECT part, entry, list(y ORDER BY pos) AS x FROM ("
            f"SELECT part, entry, pos, CAST(floor(sum(y)::DOUBLE / count(*)) AS BIGINT) AS y FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS pos FROM a{number}) "
            "GROUP BY ALL) GROUP BY ALL) m USING (part, entry))"
        )

    whole = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = ", ".join(f"{assigned(k)}, {moved(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE {whole}),
cut AS MATERIALIZED (SELECT vec_id, label, part, x[part * (len(x) // 4) + 1 : (part + 1) * (len(x) // 4)] AS x FROM kept, (SELECT unnest(range(4)) AS part)),
b0 AS MATERIALIZED (SELECT part, entry, x FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM cut) WHERE entry < 256),
{steps}, {assigned(ROUNDS)},
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS}),
coded AS (SELECT vec_id, label, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY ALL)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, book
"""


SQL = _sql()
