"""Quality rules: hashed n-gram log-likelihood ratio between trusted target and raw corpus.

Two multinomials over hashed word uni- and bigrams are counted: one over every document of the
corpus, one over the documents that `labels` trusts (quality = 1). A document's score is the mean
over its n-grams of log(p_target / p_raw), and it passes if the mean reaches one threshold.

The threshold is not a constant of some corpus: trusted documents are split in two halves by their
ids' hash, each half is scored by the ratios that the other half gives, and the threshold is the
score that a share of `MISSED` of them does not reach. It is taken from counts of scores in steps
of 1 / `STEPS`, so every trusted document counts and reruns agree.

Counting covers all documents: each task adds its own texts into vectors of `2**bits` counts and
emits only their non-zero cells, so what is shuffled for them is bounded by the number of tasks,
not of words, and no key is hot. Which documents are trusted is a join with the ids of the labels.
It is one plan at every size: the texts of documents that a filter of fixed size can't rule out are
shuffled by id to the labels' ids, the others stay where they are. Only tables of `2**bits` log
ratios come to the driver and go out again with the scoring map.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.idsets import suspects
from corvane.llm.words import SPACES, WordHash, binary_column, blank_words, pair_hash, spread
from corvane.session import checkpointed
from corvane.sources.tables import table

BITS = 18
#: Share of the trusted documents, scored by the other half's counts, that the threshold gives up.
MISSED = 0.002
STEPS = 1000
#: Pseudo-counts that draw each cell's ratio towards 1, as a share of the trusted counts per cell; 1 at least.
PRIOR = 0.3
#: Cells that are gathered before they are added to a task's counts.
GATHERED = 1 << 20
MIN_WORDS = 50
MAX_REPEATED = 0.5

SYMBOLS = b"#*$%&|<>"
#: Bytes of UTF-8 that do not begin a code point.
CONTINUATION = bytes(range(0x80, 0xC0))


def ngram_cells(ids: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of all unigrams and bigrams of a text's word hashes."""
    return np.concatenate((spread(ids, bits), spread(pair_hash(ids[:-1], ids[1:], 1), bits)))


def _count(bits: int):
    """Counts of n-grams by the column half (0 or 1) of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, gathered, waiting = WordHash(), ([], []), 0
        counts = np.zeros((2, 1 << bits), np.int64)

        def add() -> None:
            for half, cells in enumerate(gathered):
                if cells:
                    counts[half] += np.bincount(np.concatenate(cells), minlength=1 << bits)
                    cells.clear()

        for batch in batches:
            for half, data in zip(batch.column("half").to_pylist(), binary_column(batch, "text"), strict=True):
                cells = ngram_cells(hashes.ids(blank_words(data)), bits)
                gathered[half].append(cells)
                waiting += len(cells)
                if waiting > GATHERED:
                    add()
                    waiting = 0
        add()
        for half in (0, 1):
            used = np.flatnonzero(counts[half])
            columns = [pa.array(np.full(len(used), half)), pa.array(used), pa.array(counts[half][used])]
            yield pa.RecordBatch.from_arrays(columns, names=["half", "cell", "n"])

    return run


def ngram_counts(texts: DataFrame, bits: int) -> np.ndarray:
    """(2, 2**bits) counts over all rows of (half, text)."""
    counted = texts.mapInArrow(_count(bits), "half long, cell long, n long").groupBy("half", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, 1 << bits))
    counts[counted["half"], counted["cell"]] = counted["n"]
    return counts


def trusted_texts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(half, text) of the documents whose id has a label of quality 1 and none of 0.

    The labels are one small row per id (pre-aggregated, so repeated ids cannot multiply documents).
    """
    good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_q")).where("_q = 1").select("_id")
    good = checkpointed(good)
    maybe, _ = suspects(documents.select("doc_id", "text"), "doc_id", good)
    found = maybe.join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")
    return checkpointed(found.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), "text"))


def ratios_of(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) of each cell, drawn towards 0; all 0 without any target."""
    if not target.sum():
        return np.zeros(len(raw), np.float32)
    prior = max(1.0, PRIOR * target.sum() / len(raw))
    return np.log((target + prior) / (raw * (target.sum() / raw.sum()) + prior)).astype(np.float32)


def threshold_of(trusted: DataFrame, ratios: list[np.ndarray], bits: int, missed: float = MISSED) -> float:
    """The score below which a share `missed` of the trusted texts lie, 0 at most.

    ratios[half] scores the texts of that half. Texts that fail the base rules are left out; without any it is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            steps = []
            for half, data in zip(batch.column("half").to_pylist(), binary_column(batch, "text"), strict=True):
                words = blank_words(data)
                ids = hashes.ids(words)
                if not base_failed(len(words), repeated_words(words, ids)):
                    steps.append(int(np.floor(ratios[half][ngram_cells(ids, bits)].mean(dtype=np.float64) * STEPS)))
            yield pa.RecordBatch.from_arrays([pa.array(steps, pa.int64())], names=["step"])

    found = trusted.mapInArrow(run, "step long").groupBy("step").count().orderBy("step").collect()  # a step per 1 / STEPS of a log ratio
    allowed, below = missed * sum(r["count"] for r in found), 0
    for row in found:
        below += row["count"]
        if below > allowed:
            return min(0.0, row["step"] / STEPS)
    return 0.0


def base_failed(n_words: int, n_repeated: int) -> bool:
    return n_words < MIN_WORDS or n_repeated > MAX_REPEATED * n_words


def repeated_words(words: list[bytes], ids: np.ndarray) -> int:
    """Words inside any 3-word window that the text has twice or more, exactly.

    Windows are compared by a hash first, and only if two hashes agree by the words themselves.
    """
    if len(words) < 4:
        return 0
    mixed = np.sort(pair_hash(pair_hash(ids[:-2], ids[1:-1], 3), ids[2:], 4))
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    numbers: dict[bytes, int] = {}
    order = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    size = len(numbers)
    if size < 2_000_000:  # three numbers fit 63 bits
        keys = (order[:-2] * size + order[1:-1]) * size + order[2:]
    else:
        pairs = np.unique(order[:-1] * size + order[1:], return_inverse=True)[1]
        keys = pairs[:-1] * size + order[2:]
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    often = count[place] > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift : shift + len(often)] |= often
    return int(hit.sum())


def base_measures(data: bytes, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, given its words and their hashes."""
    solid = data.translate(None, SPACES)
    points = len(solid.translate(None, CONTINUATION))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(words), points, symbols, len(lines) - len(set(lines)), repeated_words(words, ids)


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


def _judge(ratios: np.ndarray, bits: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in batches:
            rows = []
            for data in binary_column(batch, "text"):
                words = blank_words(data)
                ids = hashes.ids(words)
                measures = base_measures(data, words, ids)
                score = float(ratios[ngram_cells(ids, bits)].mean(dtype=np.float64)) if words else 0.0
                failed = base_failed(measures[0], measures[4])
                rows.append((*measures, failed, score, not failed and score >= threshold))
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names]
            )

    return run


def fit(documents: DataFrame, labels: DataFrame, bits: int = BITS, missed: float = MISSED) -> tuple[np.ndarray, float]:
    """(log ratios of all cells, threshold) from all documents and all trusted ones."""
    trusted = trusted_texts(documents, labels)
    raw = ngram_counts(documents.select(F.lit(0).cast("long").alias("half"), "text"), bits)[0]
    halves = ngram_counts(trusted, bits)
    threshold = threshold_of(trusted, [ratios_of(halves[1 - half], raw) for half in (0, 1)], bits, missed)
    return ratios_of(halves.sum(axis=0), raw), threshold


def quality_rules(documents: DataFrame, labels: DataFrame, bits: int = BITS, missed: float = MISSED) -> DataFrame:
    """One row per row of `documents` with the base measures, the score and the verdict.

    Null and empty texts: all measures 0, base_failed. Repeated rows are counted and judged each
    for itself. An id that has labels of both qualities is not trusted, nor is a null id. Without
    trusted documents every score and the threshold are 0. Further columns of either table are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ratios, threshold = fit(docs, labels, bits, missed)
    return docs.mapInArrow(_judge(ratios, bits, threshold), RESULT)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

#: The base measures, which `quality_base_measures` returns; the score has no form in SQL.
BASE_SQL = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
word AS (SELECT r, doc_id, t, {_WORDS} AS w FROM doc),
win AS (SELECT r, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS x FROM word, unnest(range(1, len(w) - 1)) AS u(i)),
often AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, x) > 1),
repeated AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY r),
line AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM doc),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM line WHERE regexp_matches(x, '[^ 	-]') GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[ 	-]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
  len(w) < 50 OR 100 * coalesce(repeated.n, 0) > 50 * len(w) AS base_failed
FROM word LEFT JOIN repeated USING (r) LEFT JOIN dup USING (r)
"""


def quality_base_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the operator's result that SQL can express."""
    return op8_quality_rules(spark, sf_dir).drop("score", "kept")
