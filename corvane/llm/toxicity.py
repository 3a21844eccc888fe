"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed unigrams, bigrams and one-word skip-grams of the lower-cased
alphanumeric words. Training sees a bounded sample of the labelled rows (`max_rows`, the rows with
the smallest hash of their id) and runs inside one executor task, so only its result comes to the
driver: the non-zero weights. L1 leaves few of them, and per-coordinate rates let rare insults
learn as fast as frequent words. The weights (at most `2**bits`, proven by the table's size) go
out with the scoring map, which reads each text once and shuffles nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.words import ROWS_OUT, WordHash, alnum_words, binary_column, pair_hash, spread
from corvane.session import bounded_batches
from corvane.sources.tables import table

BITS = 20
#: Labelled rows that training reads at most.
MAX_ROWS = 12_000
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.02
#: Each epoch passes over the sample once; small samples get more of them.
STEPS, MIN_EPOCHS, MAX_EPOCHS = 24_000, 2, 25
#: A cell enters the model only if that many training texts have it.
MIN_SUPPORT = 5
#: Misses that one false alarm costs, where the cut is set.
FALSE_ALARM = 3.0
CUT = 0.7


def features(words: list[bytes], hashes: WordHash, bits: int = BITS) -> np.ndarray:
    """Hash cells of unigrams, bigrams and skip-grams (one word left out), repeats included."""
    ids = hashes.ids(words)
    return np.concatenate(
        (
            spread(ids, bits),
            spread(pair_hash(ids[:-1], ids[1:], 1), bits),
            spread(pair_hash(ids[:-2], ids[2:], 2), bits),
        )
    )


class Ftrl:
    """FTRL-proximal over binary features with dense state; the bias is not regularised."""

    def __init__(self, bits: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias_z, self.bias_n = 0.0, 0.0

    def weights(self, cells: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[cells], self.n[cells]
        shrunk = np.sign(z) * np.maximum(0.0, np.abs(z) - self.l1)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    @property
    def bias(self) -> float:
        return -self.bias_z / ((self.beta + math.sqrt(self.bias_n)) / self.alpha)

    def learn(self, cells: np.ndarray, label: int) -> None:
        """One step; `cells` are distinct."""
        weights = self.weights(cells)
        gradient = sigmoid(self.bias + float(weights.sum())) - label
        old = self.n[cells]
        new = old + gradient * gradient
        self.z[cells] += gradient - (np.sqrt(new) - np.sqrt(old)) / self.alpha * weights
        self.n[cells] = new
        grown = self.bias_n + gradient * gradient
        self.bias_z += gradient - (math.sqrt(grown) - math.sqrt(self.bias_n)) / self.alpha * self.bias
        self.bias_n = grown


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def _train(examples: list[tuple[np.ndarray, int]], bits: int, seed: int) -> Ftrl:
    model = Ftrl(bits)
    support = np.zeros(1 << bits, np.int32)
    for cells, _ in examples:
        support[cells] += 1
    kept = [(cells[support[cells] >= MIN_SUPPORT], label) for cells, label in examples]
    order = np.random.default_rng(seed)
    for _ in range(max(MIN_EPOCHS, min(MAX_EPOCHS, STEPS // max(1, len(kept))))):
        for k in order.permutation(len(kept)):
            model.learn(*kept[k])
    return model


def _cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit with the least cost of errors, a false alarm costing FALSE_ALARM misses.

    Among equally good ones the middle of the widest gap.
    """
    order = np.argsort(logits, kind="stable")
    logits, labels = logits[order], labels[order]
    missed = np.concatenate(([0], np.cumsum(labels)))
    alarms = (labels == 0).sum() - np.concatenate(([0], np.cumsum(labels == 0)))
    cost = missed + FALSE_ALARM * alarms
    edges = np.concatenate(([logits[0] - 2.0], logits, [logits[-1] + 2.0]))
    gap = np.where(cost == cost.min(), np.diff(edges), -1.0)
    best = int(np.argmax(gap))
    return float(edges[best] + edges[best + 1]) / 2


def train(examples: list[tuple[np.ndarray, int]], bits: int = BITS, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """(cells, weights, bias) of the non-zero weights; (cells, label) examples in a fixed order.

    Two half models score each other's half; the bias of the model of all examples is moved so
    that the best cut of these unseen logits gets the score CUT.
    """
    if not examples:
        return np.zeros(0, np.int64), np.zeros(0), -10.0
    logits, labels = [], []
    for half in (0, 1):
        model = _train(examples[half::2], bits, seed + half)
        table, bias = model.weights(slice(None)), model.bias
        for cells, label in examples[1 - half :: 2]:
            logits.append(bias + float(table[cells].sum()))
            labels.append(label)
    offset = math.log(CUT / (1 - CUT)) - _cut(np.array(logits), np.array(labels)) if any(labels) else 0.0
    model = _train(examples, bits, seed)
    weights = model.weights(slice(None))
    cells = np.flatnonzero(weights)
    return cells, weights[cells], model.bias + offset


def held_out() -> Column:
    """crc32 of the id as text mod 3 is 1; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most max_rows labelled rows outside the held-out third.

    Of labels and texts, one per id (toxic if any says so; the smallest text). The bound is cut by
    the id's hash before any text is joined, so the texts of unsampled rows are never moved.
    """
    picked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")  # max_rows ids
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )


def _fit(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        hashes = WordHash()
        texts, toxic = rows["text"], rows["toxic"]
        examples, chunk = [], []

        def pack() -> None:
            """Many small arrays become views of one, which the system gets back when they go."""
            joined, at = np.concatenate([cells for cells, _ in chunk]), 0
            for cells, label in chunk:
                examples.append((joined[at : at + len(cells)], label))
                at += len(cells)
            chunk.clear()

        for k in pc.sort_indices(rows["doc_id"]).to_pylist():
            words = alnum_words((texts[k].as_py() or "").encode())
            chunk.append((np.unique(features(words, hashes, bits)).astype(np.int32), int(toxic[k].as_py() > 0)))
            if len(chunk) == 500:
                pack()
        if chunk:
            pack()
        cells, weights, bias = train(examples, bits)
        return pa.table({"cell": pa.array([-1, *cells.tolist()], pa.int64()), "weight": pa.array([bias, *weights.tolist()], pa.float64())})

    return run


def fit(documents: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    rows = (
        training_rows(documents, labels, max_rows)
        .groupBy((F.col("doc_id") * 0).alias("_all"))  # one task: at most max_rows texts
        .applyInArrow(_fit(bits), "cell long, weight double")
        .toPandas()
        .sort_values("cell")
    )
    if rows.empty:
        return np.zeros(0, np.int64), np.zeros(0), -10.0
    return rows["cell"].to_numpy()[1:], rows["weight"].to_numpy()[1:], float(rows["weight"].iloc[0])


class Scorer:
    """Logistic score of a text; keeps the words' hashes and a dense table of the weights."""

    def __init__(self, model: tuple[np.ndarray, np.ndarray, float], bits: int = BITS):
        cells, weights, self.bias = model
        self.bits, self.hashes = bits, WordHash()
        self.table = np.zeros(1 << bits)
        self.table[cells] = weights
        self.used = self.table != 0

    def score(self, data: bytes) -> float:
        cells = features(alnum_words(data), self.hashes, self.bits)
        cells = np.unique(cells[self.used[cells]])
        return sigmoid(self.bias + float(self.table[cells].sum()))


def _score(model: tuple[np.ndarray, np.ndarray, float], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, bits)
        for batch in batches:
            scores = [scorer.score(data) for data in binary_column(batch, "text")]
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(scores, pa.float64())], names=[*names, "score"]
            )

    return run


def score_toxicity(documents: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= cut) for every row of `documents`.

    A null or empty text has the bias as its score. Repeated rows get equal scores. Without
    usable labels every score is about 0. Further columns of either table are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(docs, labels, bits, max_rows)
    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _score(model, bits), "doc_id long, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def _keep(model: tuple[np.ndarray, np.ndarray, float], bits: int, cut: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, bits)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_OUT):  # whole rows go out in small batches
                part = batch.slice(start, ROWS_OUT)
                good = [scorer.score(data) < cut for data in binary_column(part, "text")]
                yield part.filter(pa.array(good, pa.bool_()))

    return run


def reject_toxic(documents: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, cut: float = CUT) -> DataFrame:
    """The rows of `documents` that score below cut, with all their columns."""
    model = fit(documents, labels, bits, max_rows)
    bounded_batches(documents.sparkSession)
    return documents.mapInArrow(_keep(model, bits, cut), documents.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
