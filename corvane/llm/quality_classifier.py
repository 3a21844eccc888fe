"""Quality classifier by co-training.

Two separate views of a document: its text content (hashed words, nothing else) and its page metadata
(language, source and length columns and the layout of its lines, no word). A classifier of each view is
trained on labelled documents; in each of `ROUNDS` rounds both score the WHOLE unlabelled table in one
map, and the documents that a view is surest of, `HANDED` by either class's share, join the other
view's training set. At the end each view is calibrated on labelled documents that neither training
nor the rounds have seen, and the score is the probability from both calibrated log-odds, weighed on
the same documents and drawn towards their plain sum less the prior counted twice, which would be
right for independent views.

Fitting reads at most `MAX_LABELLED` labelled documents (those with the smallest hashes of their ids)
and the documents handed over, `2 * HANDED * ROUNDS` at most, in one executor task; only the weights,
of fixed size, come back. Which documents are unlabelled is decided on scored rows of a few bytes,
joined by id with all labels, so texts are never shuffled but for those of the documents chosen.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.words import WordHash, binary_column, blank_words, spread
from corvane.session import checkpointed
from corvane.sources.tables import table

BITS = 14
#: Labelled documents that fitting reads at most.
MAX_LABELLED = 6_000
ROUNDS = 3
#: Documents that each view hands over per round, and what it needs to be sure of one: a confidence, and
#: log-odds that far from the prior's, as a view that knows little is confident of the common class.
HANDED, SURE, FAR = 300, 0.9, 3.0
#: Documents that score below are not kept.
CUT = 0.5
LANGUAGES = ("en", "de", "fr", "es")
#: Cells of hashed sources, steps of log2 of the length, measures of layout.
SOURCES, LENGTHS, LAYOUT = 32, 12, 6
META = len(LANGUAGES) + SOURCES + LENGTHS + LAYOUT


def text_cells(texts: list[bytes], hashes: WordHash, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, value), by row: hashed words by the root of their frequency, each row scaled to unit length."""
    ids = [hashes.ids(blank_words(t)) for t in texts]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    keys = (np.repeat(np.arange(len(ids)), sizes) << bits) + spread(np.concatenate([*ids, np.zeros(0, np.uint64)]), bits)
    keys, counts = np.unique(keys, return_counts=True)
    rows, values = keys >> bits, np.sqrt(counts)
    norms = np.sqrt(np.bincount(rows, counts, minlength=len(ids)))
    return rows, keys & ((1 << bits) - 1), values / norms[rows]


def meta_rows(texts: list[bytes], langs: list[str | None], sources: list[str | None], lengths: list[int | None]) -> np.ndarray:
    """A row per document, all within about [0, 1]; what is null or unknown has no cell."""
    out = np.zeros((len(texts), META))
    at = len(LANGUAGES) + SOURCES
    for row, data, lang, source, length in zip(out, texts, langs, sources, lengths, strict=True):
        if lang in LANGUAGES:
            row[LANGUAGES.index(lang)] = 1.0
        if source is not None:
            row[len(LANGUAGES) + zlib.crc32(source.encode("utf-8", "replace")) % SOURCES] = 1.0
        if length is not None:
            row[at + min(LENGTHS - 1, max(0, int(max(0, length)).bit_length() - 5))] = 1.0
        lines = data.split(b"\n")
        full = [x for x in lines if x and not x.isspace()]
        n, size = max(1, len(full)), sum(map(len, full))
        row[-LAYOUT:] = (
            math.log1p(len(full)) / 8,
            math.log1p(size / n) / 8,
            math.log1p(max(map(len, full), default=0)) / 8,
            (len(full) - len(set(full))) / n,
            sum(len(x) < 40 for x in full) / n,
            (len(lines) - len(full)) / len(lines),
        )
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Logistic:
    """Logistic regression on sparse rows [(cells, values)], AdaGrad with L2, classes weighed alike."""

    def __init__(self, size: int, l2: float, rate: float = 0.5, epochs: int = 8):
        self.size, self.l2, self.rate, self.epochs = size, l2, rate, epochs
        self.weights, self.bias = np.zeros(size), 0.0
        self.slope, self.offset = 1.0, 0.0

    def fit(self, rows: list, labels: np.ndarray, seed: int) -> None:
        weights, seen = np.zeros(self.size), np.full(self.size, 1e-2)
        bias, bias_seen = 0.0, 1e-2
        share = np.clip(labels.mean(), 0.02, 0.98)
        weigh = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
        order = np.random.default_rng(seed)
        for _ in range(self.epochs):
            for k in order.permutation(len(rows)):
                cells, values = rows[k]
                error = weigh[k] * (1 / (1 + math.exp(-min(30.0, max(-30.0, float(weights[cells] @ values) + bias)))) - labels[k])
                grad = error * values + self.l2 * weights[cells]
                seen[cells] += grad**2
                weights[cells] -= self.rate * grad / np.sqrt(seen[cells])
                bias_seen += error**2
                bias -= self.rate * error / np.sqrt(bias_seen)
        self.weights, self.bias = weights, bias

    def logits(self, rows: list) -> np.ndarray:
        return np.array([self.weights[c] @ v + self.bias for c, v in rows])

    def calibrate(self, rows: list, labels: np.ndarray) -> None:
        """Platt scaling by damped Newton steps; a weak prior keeps the slope near 1."""
        self.slope, self.offset = 1.0, 0.0
        if not len(rows) or not 0 < labels.sum() < len(labels):
            return
        positive = labels.sum()
        goal = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
        x = np.stack((self.logits(rows), np.ones(len(rows))))
        found, prior = np.array([1.0, 0.0]), np.array([1.0, 0.0])
        for _ in range(60):
            p = _sigmoid(found @ x)
            step = np.linalg.solve((x * (p * (1 - p))) @ x.T + np.eye(2), x @ (p - goal) + (found - prior))
            found = found - np.clip(step, -0.5, 0.5)
        self.slope, self.offset = max(0.05, float(found[0])), float(found[1])

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return self.slope * logits + self.offset


class Models:
    """The classifier of each view and the log-odds of the labelled documents."""

    def __init__(self, bits: int):
        self.bits, self.prior, self.mix = bits, 0.0, np.array([1.0, 1.0, 0.0])
        self.text, self.meta = Logistic(1 << bits, 1e-4), Logistic(META, 1e-4)

    def combine(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return self.mix[0] * text + self.mix[1] * meta + self.mix[2]

    def weigh(self, text: np.ndarray, meta: np.ndarray, labels: np.ndarray) -> None:
        """Logistic regression of the labels on both views' log-odds by damped Newton steps."""
        self.mix = start = np.array([1.0, 1.0, -self.prior])
        if len(set(labels)) < 2:
            return
        x = np.stack((text, meta, np.ones(len(text))))
        for _ in range(60):
            p = _sigmoid(self.mix @ x)
            step = np.linalg.solve((x * (p * (1 - p))) @ x.T + np.eye(3), x @ (p - labels) + (self.mix - start))
            self.mix = np.append(np.maximum(0.0, (self.mix - np.clip(step, -0.5, 0.5))[:2]), self.mix[2] - np.clip(step, -0.5, 0.5)[2])

    def log_odds(self, texts: list[bytes], langs: list, sources: list, lengths: list, hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds of the text view and of the metadata view."""
        rows, cells, values = text_cells(texts, hashes, self.bits)
        text = np.bincount(rows, self.text.weights[cells] * values, minlength=len(texts)) + self.text.bias
        meta = meta_rows(texts, langs, sources, lengths) @ self.meta.weights + self.meta.bias
        return self.text.calibrated(text), self.meta.calibrated(meta)


def fit_views(frame: pd.DataFrame, bits: int, last: bool) -> Models:
    """Both views from rows (doc_id, text, lang, source, n_chars, label, for_text, for_meta).

    Rows that are for both views are labelled; of these one in eight by position is kept for calibration
    during the rounds and another one in eight for the last calibration. The others are pseudo-labelled.
    """
    frame = frame.sort_values(["doc_id"]).reset_index(drop=True)
    texts = [(t or "").encode() for t in frame["text"]]
    labels = frame["label"].to_numpy(float)
    rows, cells, values = text_cells(texts, WordHash(), bits)
    ends = np.searchsorted(rows, np.arange(len(texts) + 1))
    dense = np.arange(META)
    lengths = [None if pd.isna(n) else int(n) for n in frame["n_chars"]]
    views = (
        [(cells[a:b], values[a:b]) for a, b in zip(ends, ends[1:], strict=False)],
        [(dense, row) for row in meta_rows(texts, list(frame["lang"]), list(frame["source"]), lengths)],
    )
    models, known = Models(bits), np.flatnonzero(frame["for_text"] & frame["for_meta"])
    share = float(np.clip(labels[known].mean(), 0.02, 0.98)) if len(known) else 0.5
    models.prior = math.log(share / (1 - share))
    check = known[(4 if last else 0) :: 8]
    learn = np.setdiff1d(known, np.union1d(known[::8], known[4::8]))
    if len(set(labels[learn])) < 2 or len(set(labels[check])) < 2:
        check, learn = known[:0], known
    if len(set(labels[learn])) < 2:
        return models
    for view, model, given in zip(views, (models.text, models.meta), ("for_text", "for_meta"), strict=True):
        pseudo = np.flatnonzero(frame[given] & ~(frame["for_text"] & frame["for_meta"]))
        use = np.concatenate((learn, pseudo))
        model.fit([view[k] for k in use], labels[use], seed=len(pseudo))
        model.calibrate([view[k] for k in check], labels[check])
    text, meta = (m.calibrated(m.logits([view[k] for k in check])) for view, m in zip(views, (models.text, models.meta), strict=True))
    models.weigh(text, meta, labels[check])
    return models


def _fit(bits: int, last: bool):
    return lambda frame: _packed(fit_views(frame, bits, last))


def _packed(models: Models) -> pd.DataFrame:
    cells = np.flatnonzero(models.text.weights)
    single = [models.prior, *models.mix, *(x for m in (models.text, models.meta) for x in (m.bias, m.slope, m.offset))]
    parts = {"text": (cells, models.text.weights[cells]), "meta": (range(META), models.meta.weights), "single": (range(len(single)), single)}
    return pd.concat([pd.DataFrame({"part": name, "cell": cells, "value": values}) for name, (cells, values) in parts.items()]).astype({"value": float})


def _unpacked(rows: pd.DataFrame, bits: int) -> Models:
    parts = {name: part.sort_values("cell") for name, part in rows.groupby("part")}
    models = Models(bits)
    if "text" in parts:
        models.text.weights[parts["text"]["cell"]] = parts["text"]["value"]
    models.meta.weights = parts["meta"]["value"].to_numpy()
    models.prior, *rest = map(float, parts["single"]["value"])
    models.mix, rest = np.array(rest[:3]), rest[3:]
    for model, (bias, slope, offset) in zip((models.text, models.meta), (rest[:3], rest[3:]), strict=True):
        model.bias, model.slope, model.offset = bias, slope, offset
    return models


_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_TRAINING = (*_COLUMNS, "label", "for_text", "for_meta")


def training_rows(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents of `chosen` (doc_id, label, for_text, for_meta; a bounded number), one row per id, written."""
    picked = chosen.withColumnRenamed("doc_id", "_id")
    rows = documents.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")
    row = F.min(F.struct("text", "lang", "source", "n_chars", "label", "for_text", "for_meta")).alias("row")
    return checkpointed(rows.groupBy("doc_id").agg(row).select("doc_id", "row.*"))


def fit(documents: DataFrame, labels: DataFrame, bits: int, max_labelled: int, rounds: int) -> Models | None:
    """The trained models; None if no document is labelled."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("double").alias("label"))
    marked = checkpointed(marked)
    rank = (F.xxhash64("doc_id"), "doc_id")
    yes = F.lit(True)
    known = marked.orderBy(*rank).limit(max_labelled).select("doc_id", F.when(F.col("label") > 0, 1.0).otherwise(0.0).alias("label"), yes.alias("for_text"), yes.alias("for_meta"))
    training, taken = training_rows(documents, known), []
    for turn in range(rounds + 1):
        fitted = (
            training.select(*_TRAINING)
            .groupBy((F.col("doc_id") * 0).alias("_all"))  # one task: a bounded number of documents
            .applyInPandas(_fit(bits, turn == rounds), "part string, cell long, value double")
            .toPandas()
        )
        if fitted.empty:
            return None
        models = _unpacked(fitted, bits)
        if turn == rounds:
            return models
        good = float(_sigmoid(np.array(max(math.log(SURE / (1 - SURE)), models.prior + FAR))))
        bad = float(_sigmoid(np.array(min(-math.log(SURE / (1 - SURE)), models.prior - FAR))))
        sure = scored(documents, models, bits).where(
            f"doc_id is not null and (greatest(text_score, meta_score) >= {good} or least(text_score, meta_score) <= {bad})"
        )
        pool = sure.groupBy("doc_id").agg(F.min("text_score").alias("text_score"), F.min("meta_score").alias("meta_score"))
        for known_ids in (marked, *taken):
            pool = pool.join(known_ids.select("doc_id"), "doc_id", "left_anti")
        pool = checkpointed(pool)
        share = 1 / (1 + math.exp(-models.prior))
        picks = []
        for own, other in (("text", "meta"), ("meta", "text")):
            for label in (1.0, 0.0):
                score = F.col(f"{own}_score")
                confidence, enough = (score, score >= good) if label else (-score, score <= bad)
                number = max(1, round(HANDED * (share if label else 1 - share)))
                best = pool.where(enough).orderBy(confidence.desc(), *rank).limit(number)
                picks.append(best.select("doc_id", F.lit(label).alias("label"), F.lit(other == "text").alias("for_text"), F.lit(other == "meta").alias("for_meta")))
        each = functools.reduce(DataFrame.unionByName, picks).groupBy("doc_id").agg(
            F.min("label").alias("label"), F.max("label").alias("most"), F.max("for_text").alias("for_text"), F.max("for_meta").alias("for_meta")
        )
        # a document that both views chose teaches nobody anything new, or they disagree: it goes to neither
        chosen = checkpointed(each.where("label = most and not (for_text and for_meta)").drop("most"))
        taken.append(chosen)
        training = training.unionByName(training_rows(documents, chosen))
    return None


def _score(models: Models | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                a, b, both = np.zeros((3, batch.num_rows))
                if models is not None:
                    texts = list(binary_column(batch, "text"))
                    a, b = models.log_odds(texts, *(batch.column(c).to_pylist() for c in _COLUMNS[2:]), hashes)
                    both = models.combine(a, b)
                scores = [pa.array(_sigmoid(x)) for x in (a, b, both)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *scores], names=["doc_id", "text_score", "meta_score", "score"])

    return run


def scored(documents: DataFrame, models: Models | None, bits: int) -> DataFrame:
    return documents.mapInArrow(_score(models), "doc_id long, text_score double, meta_score double, score double")


def classify_quality(
    documents: DataFrame,
    labels: DataFrame,
    bits: int = BITS,
    max_labelled: int = MAX_LABELLED,
    rounds: int = ROUNDS,
    cut: float = CUT,
) -> DataFrame:
    """doc_id, text_score, meta_score, score (0 to 1, higher is better) and kept (score >= cut).

    Null and empty texts are scored as empty; null or unknown metadata has no feature. An id labelled
    with both qualities counts as 0. Without labels of both classes every score is the prior's;
    without documents or labels at all it is 0.5. Repeated rows get equal scores.
    """
    kinds = {"doc_id": "long", "n_chars": "long"}
    docs = documents.select(*(F.col(c).cast(kinds.get(c, "string")).alias(c) for c in _COLUMNS))
    models = fit(docs, labels, bits, max_labelled, rounds)
    return scored(docs, models, bits).withColumn("kept", F.col("score") >= cut)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
