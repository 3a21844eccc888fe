"""Mixing sources to target weights by the cube method.

Targets: the sources in order of their names (null last) weigh 5, 2, 1 and so on, and share the
total size; no target exceeds `REPEAT` times its source's size, the excess going to the others by
weight. With r = target / source size, every document of the source is taken floor(r) times, and
one time more with the inclusion probability r - floor(r). Which documents get the extra copy is
a balanced sample:

* Flight: the vector of probabilities walks through the null space of two constraints, the number
  of documents and of words. Three undecided documents always leave one direction in which both
  totals stand still; a step along it, up or down by a seeded coin that keeps all probabilities
  as they are in expectation, decides at least one of them. So a block of any size streams through
  a window of three undecided documents.
* Blocks: documents are dealt by hash into blocks of about `block_rows` within their source, and
  each block flies by itself; at most two, and the `RESERVE` largest, which wait, remain undecided.
* Tree of flights: the undecided ones are dealt into blocks anew and fly again, until all of a
  source fit one block. Every flight leaves some 12 of `block_rows`, so no task ever sees more than
  about a block of a source, however many documents that has.
* Landing: the last flight of a source leaves at most `RESERVE` + 2, and of their outcomes the one
  nearest to the source's totals is taken.

The rows that move are (id, source, size), never texts. Coins are hashes of ids and the order in
a block is by size, hash and id, so reruns agree whatever the partitioning. Sources are ranked and
levelled by sorted partitions and one-row aggregates, never all in one task.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.session import checkpointed
from corvane.sources.tables import table

WEIGHTS = (5, 2, 1)
REPEAT = 3
BLOCK_ROWS = 8192


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text; 0 for null."""
    pieces = F.split(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+")
    blank = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when(F.element_at(pieces, -1) == "", 1).otherwise(0)
    return F.greatest(F.size(pieces) - blank, F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """`sources` with the column place: 0, 1, ... in the order of the column source, null last.

    Range partitions are written sorted; the rows before each are the sums of the counts of those
    before it, a table of one row per partition.
    """
    parts = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = checkpointed(parts)
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return parts.withColumn("inside", inside).join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeat: int = REPEAT) -> DataFrame:
    """One row per source of (source, size): source, source_size, n_rows, target, rate.

    The level is what a unit of weight gets. Sources whose cap is below their weight's share at
    the present level are capped and the rest levelled anew, which can only raise the level, until
    no more are; each step is an aggregate of one row, over a written table of one row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    weighed = checkpointed(ranked(sources).withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int"))))
    cap = (repeat * F.col("source_size")).cast("double")
    level, capped = 0.0, F.lit(False)
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    n_open = -1
    while True:
        held, open_, count = weighed.agg(
            F.sum(F.when(capped, repeat * F.col("source_size")).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.count_if(~capped)
        ).first()
        if not count or count == n_open:  # all are capped, or no more than before
            break
        level, n_open = (total - held) / open_, count
        capped = cap <= level * F.col("weight")
    target = F.when(capped, cap).otherwise(level * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(repeat)))).otherwise(0.0)
    return weighed.select("source", "source_size", "n_rows", target.alias("target"), rate.alias("rate"))


class Flight:
    """The window of undecided units of one stratum: (p, size, row)."""

    def __init__(self):
        self.window: list[list] = []

    def add(self, p: float, size: int, coin: float, row: int) -> list[tuple[int, int]]:
        """Takes a unit in; the (row, 0 or 1) of units that this decides."""
        self.window.append([p, size, row])
        done = []
        while len(self.window) == 3:
            (p0, a, _), (p1, b, _), (p2, c, _) = self.window
            step = (b - c, c - a, a - b)
            if step == (0, 0, 0):
                step = (1, -1, 0)
            now = (p0, p1, p2)
            up = min((1 - x) / s if s > 0 else x / -s for x, s in zip(now, step, strict=True) if s)
            down = min(x / s if s > 0 else (1 - x) / -s for x, s in zip(now, step, strict=True) if s)
            move = up if coin * (up + down) < down else -down
            kept = []
            for unit, s in zip(self.window, step, strict=True):
                unit[0] += move * s
                if unit[0] < 1e-9 or unit[0] > 1 - 1e-9:
                    done.append((unit[2], int(unit[0] > 0.5)))
                else:
                    kept.append(unit)
            if len(kept) == 3:  # rounding hid the decision: decide the nearest
                nearest = min(kept, key=lambda u: min(u[0], 1 - u[0]))
                kept.remove(nearest)
                done.append((nearest[2], int(nearest[0] > 0.5)))
            self.window = kept
        return done


def coin(seed: int, level: int) -> float:
    return zlib.crc32(f"{level}:{seed}".encode()) / 2**32


def _fly(level: int, reserve: int):
    """Streams rows sorted by key and sets p to 0 or 1 where the flight decides.

    The first (so the largest) `reserve` undecided rows of each key don't fly: they wait for the
    landing. A document much larger than the others hardly moves in a flight and would be left
    over with nothing to weigh it up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, flight, waiting = None, Flight(), 0
        held: dict[int, tuple] = {}
        number = itertools.count()
        out: list[tuple] = []

        def leave() -> None:
            out.extend((*held.pop(row)[:-1], p) for p, _, row in flight.window)

        def batch_of(schema: pa.Schema) -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        schema = None
        for batch in batches:
            schema, out = batch.schema, []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size, seed, own, p = row[SIZE], row[SEED], row[KEY], row[P]
                if own != key:
                    leave()
                    key, flight, waiting = own, Flight(), 0
                if not 0 < p < 1:
                    out.append(row)
                elif waiting < reserve:
                    waiting += 1
                    out.append(row)
                else:
                    held[at := next(number)] = row
                    out.extend((*held.pop(k)[:-1], float(decided)) for k, decided in flight.add(p, size, coin(seed, level), at))
            if out:
                yield batch_of(schema)
        out = []
        leave()
        if out:
            yield batch_of(schema)

    return run


_ROW = "doc_id long, source string, size long, source_size long, target double, whole long, seed long, key string, p double"
SIZE, SEED, KEY, P = 2, 6, 7, 8
#: Rows of each block and source that wait for the landing besides the two that a flight leaves.
RESERVE = 10
LIGHT = 0.02


def _dealt(frame: DataFrame) -> DataFrame:
    """Equal keys in one partition, in a fixed order, the largest documents first."""
    return frame.repartition("key").sortWithinPartitions("key", F.col("size").desc(), "seed", "doc_id", "p")


def landing(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The 0/1 outcome nearest to the expected words, a missed document counting as LIGHT mean sizes."""
    outcomes = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    words = np.abs(outcomes @ sizes - p @ sizes)
    count = np.abs(outcomes.sum(axis=1) - p.sum())
    return outcomes[np.argmin(words + LIGHT * sizes.mean() * count)]


def _land(rows: pa.Table) -> pa.Table:
    """Decides a source's last undecided rows, RESERVE + 2 at most."""
    rows = rows.sort_by([("seed", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
    decided = landing(rows["p"].to_numpy(), rows["size"].to_numpy().astype(np.float64)).astype(np.float64)
    return rows.set_column(P, "p", pa.array(decided))


#: Source tables of up to that many rows are sent to all executors; larger ones are joined by shuffling.
BROADCAST_SOURCES = 100_000


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeat: int = REPEAT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, size, source_size, target and taken (words) for each row, and source and copies.

    taken is a whole number of copies of the row, at most `repeat`. Rows without words are taken
    0 times. A null source is a source of its own, the last. Repeated rows are units of their
    own; a null doc_id is a unit too. An empty table gives no rows.
    """
    sizes = checkpointed(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size")
        )
    )
    wanted = targets(sizes, weights, repeat)  # one row per source
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / block_rows))
    wanted = checkpointed(wanted.withColumn("blocks", blocks).withColumnRenamed("source", "_source"))
    if wanted.count() <= BROADCAST_SOURCES:
        wanted = F.broadcast(wanted)
    joined = sizes.join(wanted, F.col("source").eqNullSafe(F.col("_source")), "left")
    seed = F.xxhash64("doc_id", "size")
    name = F.coalesce(F.concat(F.lit("s:"), "source"), F.lit("null"))
    whole = F.floor("rate")
    rows = joined.select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, whole).otherwise(0).cast("long").alias("whole"),
        seed.alias("seed"),
        F.concat(F.pmod(seed, F.col("blocks")).cast("string"), F.lit(":"), name).alias("key"),
        F.when(F.col("size") > 0, F.col("rate") - whole).otherwise(0.0).alias("p"),
    )
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    decided, level = [], 1
    while True:
        flown = checkpointed(_dealt(rows).mapInArrow(_fly(level, RESERVE), _ROW))
        decided.append(flown.where(~undecided))
        left = flown.where(undecided).withColumn("source_key", name)
        most = left.groupBy("source_key").agg(F.count("*").alias("n"))
        if (most.agg(F.max("n")).first()[0] or 0) <= RESERVE + 2:
            break
        level += 1
        need = F.greatest(F.lit(1), F.ceil(F.col("n") / block_rows)).alias("need")
        dealt = left.join(most.select(F.col("source_key").alias("_key"), need), F.col("source_key") == F.col("_key"))
        again = F.concat(F.pmod(F.xxhash64("seed", F.lit(level)), F.col("need")).cast("string"), F.lit(":"), "source_key")
        rows = dealt.select(*(again.alias(c) if c == "key" else c for c in flown.columns))
    landed = flown.where(undecided).withColumn("key", name).groupBy("key").applyInArrow(_land, _ROW)
    decided = functools.reduce(DataFrame.unionByName, decided, landed)
    copies = F.col("whole") + F.col("p").cast("long")
    return decided.select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("copies")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


#: Sizes and targets, which `mixing_targets` returns; which documents are taken has no form in SQL.
TARGETS_SQL = rf"""
WITH doc AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (
  SELECT source, sum(size) AS total, CAST([{", ".join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS INT) + 1] AS DOUBLE) AS weight
  FROM doc GROUP BY source),
levels AS (
  SELECT *, {REPEAT} * total AS cap, (sum(total) OVER () - coalesce(sum({REPEAT} * total) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM src WINDOW before AS (ORDER BY {REPEAT} * total / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (SELECT *, level * weight >= cap AS capped, max(CASE WHEN level * weight < cap THEN level END) OVER () AS share FROM levels)
SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, round(CASE WHEN capped THEN cap ELSE share * weight END, 3) AS target
FROM doc JOIN shared ON doc.source IS NOT DISTINCT FROM shared.source
"""


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the operator's result that SQL can express; targets rounded to 3 places."""
    return op6_mixing(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))
