"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is the word: a text is its word sequence, a pattern is a window of `window`
consecutive item words (an item of fewer words is one pattern). For each pattern length there are

* a shift table over hashed blocks of two words: how far the search may jump when that block ends at
  the present position (blocks that no pattern has allow the full length - 1),
* buckets of the patterns by the hash of their last block, within a bucket sorted by the hash of the
  whole pattern, so that a bucket of many patterns is searched by bisection,
* a direct comparison of the whole window with the patterns that remain.

Most positions are never looked at, and the search is one map over the documents: no shuffle, no
join. Words of the benchmark are numbered and everything else is arrays of numbers: a searcher takes
some 30 bytes per word of its patterns plus the distinct words, and nothing per window in Python.

The pattern side is cut into blocks of at most `block_bytes` bytes of text. One task builds the tables of a block
and writes them to a file in the shared folder. There is one pass over the documents at every size: a worker gathers
some texts, loads the blocks one after the other, one alive at a time, and searches the texts for each; nothing of
the documents is copied or shuffled.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.words import ROWS_OUT, alnum_words, binary_column
from corvane.session import bounded_batches, checkpointed, shared_folder
from corvane.sources.tables import table

WINDOW = 10
#: Text of one block at most; a worker holds some 5 bytes for each of it, and 16 while it builds.
BLOCK_BYTES = 16 << 20
#: Text that a worker gathers to read it against one block after the other.
GROUP_BYTES = 32 << 20
#: Words of one piece of an item; longer items are cut into pieces that overlap by a window less one word.
PIECE = 50_000
_MASK = (1 << 64) - 1
_STEP, _LEFT, _RIGHT = 0x9E3779B97F4A7C15, 0x9E3779B1, 0x85EBCA6B  # odd multipliers; word numbers stay below 2**31


def _block_hash(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """Hashes of pairs of word numbers (`WuManber.search` has the same for a pair)."""
    mixed = (left.astype(np.int64) * _LEFT) ^ (right.astype(np.int64) * _RIGHT)
    return (mixed >> 15) & ((1 << bits) - 1)


class WuManber:
    """Search for patterns of one common length among numbered words.

    codes: all words of the items in a row; starts: where the patterns start; owners: the item of each.
    """

    def __init__(self, length: int, codes: np.ndarray, starts: np.ndarray, owners: np.ndarray):
        self.length = length
        self.full = max(1, length - 1)
        self.bits = min(22, max(8, int(len(starts)).bit_length() + 3))
        last = self._blocks(codes, starts, length)
        hashes = np.zeros(len(starts), np.uint64)
        for k in range(length):
            hashes = (hashes + codes[starts + k].astype(np.uint64) + np.uint64(1)) * np.uint64(_STEP)
            hashes ^= hashes >> np.uint64(31)
        order = np.lexsort((hashes, last))
        self.starts, self.hashes, self.owners = starts[order], hashes[order], owners[order]
        self.codes = codes
        self.bucket = np.searchsorted(last[order], np.arange((1 << self.bits) + 1)).astype(np.int32)
        shift = np.full(1 << self.bits, self.full, np.uint8)
        for end in range(2, length + 1):  # later blocks of the pattern allow shorter jumps
            shift[self._blocks(codes, starts, end)] = length - end
        self.shift = shift.tobytes()

    def _blocks(self, codes: np.ndarray, starts: np.ndarray, end: int) -> np.ndarray:
        """Hashes of the two words (one, twice, in patterns of one word) that end at `end`."""
        return _block_hash(codes[starts + max(0, end - 2)], codes[starts + end - 1], self.bits)

    def search(self, words: list[bytes], number) -> Iterator[tuple[int, np.ndarray]]:
        """(start, items) of every occurrence, starts ascending; number(word) is None for a word that no item has."""
        length, full, shift, mask = self.length, self.full, self.shift, (1 << self.bits) - 1
        at, end, back = length - 1, len(words), min(1, length - 1)
        while at < end:
            right = number(words[at])
            left = right if not back else None if right is None else number(words[at - 1])
            if left is None or right is None:
                at += full
                continue
            block = ((left * _LEFT) ^ (right * _RIGHT)) >> 15 & mask
            if shift[block] and back:
                at += shift[block]
                continue
            found = self._compare(words[at - length + 1 : at + 1], number, block)
            if found is not None:
                yield at - length + 1, found
            at += 1

    def _compare(self, window: list[bytes], number, block: int) -> np.ndarray | None:
        low, high = int(self.bucket[block]), int(self.bucket[block + 1])
        if low == high:
            return None
        numbers = [number(w) for w in window]
        if None in numbers:
            return None
        value = 0
        for code in numbers:
            value = ((value + code + 1) * _STEP) & _MASK
            value ^= value >> 31
        part = self.hashes[low:high]
        first, stop = np.searchsorted(part, np.uint64(value)), np.searchsorted(part, np.uint64(value), "right")
        if first == stop:
            return None
        places = self.starts[low + first : low + stop]
        same = (self.codes[places[:, None] + np.arange(self.length)] == np.array(numbers, np.int32)).all(axis=1)
        return self.owners[low + first : low + stop][same] if same.any() else None


class Searchers:
    """One Wu-Manber searcher for each pattern length that the pieces (item id or None, text) have."""

    def __init__(self, pieces: list[tuple[str | None, bytes]], window: int = WINDOW):
        numbers: dict[bytes, int] = {}
        self.number, self.items = numbers.get, [item for item, _ in pieces]
        parts, sizes = [], np.zeros(len(pieces), np.int64)
        for k, (_, text) in enumerate(pieces):
            words = alnum_words(text)
            parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
            sizes[k] = len(words)
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        begins = np.cumsum(sizes) - sizes
        self.each = []
        for length in sorted({min(window, int(n)) for n in sizes} - {0}):
            of = np.flatnonzero(np.minimum(sizes, window) == length)
            counts = sizes[of] - length + 1
            starts = np.repeat(begins[of] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            self.each.append(WuManber(length, codes, starts.astype(np.int32), np.repeat(of, counts).astype(np.int32)))

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(word ranges of all occurrences, ids of the items that they belong to)."""
        rows, owners = [], set()
        for searcher in self.each:
            for start, found in searcher.search(words, self.number):
                rows.append((start, start + searcher.length))
                owners.update(found.tolist())
        return rows, {self.items[k] for k in owners} - {None}

    def occur(self, words: list[bytes]) -> bool:
        return any(True for searcher in self.each for _ in searcher.search(words, self.number))


def hit_words(spans: np.ndarray) -> int:
    """Size of the union of half-open [start, end) rows."""
    if not len(spans):
        return 0
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    before = np.concatenate(([0], reach[:-1]))
    return int(np.maximum(0, spans[:, 1] - np.maximum(spans[:, 0], before)).sum())


RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _groups(batches: Iterator[pa.RecordBatch], most: int | None) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about `most` bytes, one by one if None."""
    group: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if most is None or size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


class _Blocks:
    """The searchers of the benchmark's blocks, read from their files one after the other; a single one stays loaded."""

    def __init__(self, paths: list[str]):
        self.paths = paths
        self.only: Searchers | None = None
        #: Rows are gathered, so that a block is read once for many of them.
        self.group = GROUP_BYTES if len(paths) > 1 else None

    def __iter__(self) -> Iterator[Searchers]:
        if len(self.paths) == 1:
            self.only = self.only or _load(self.paths[0])
            yield self.only
            return
        if not self.paths:
            yield Searchers([])
        for path in self.paths:
            yield _load(path)  # one is alive at a time: the consumer drops the one before


def _load(path: str) -> Searchers:
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name) as source:
        return pickle.loads(source.read())


def _search(paths: list[str], window: int):
    """Maps rows to doc_id, n_words, _spans (int64 word ranges) and _items, in one pass whatever the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(paths)
        for group in _groups(batches, blocks.group):
            texts = [data for batch in group for data in binary_column(batch, "text")]
            n_words, spans, names = [0] * len(texts), [b""] * len(texts), [set() for _ in texts]
            for searchers in blocks:
                for k, data in enumerate(texts):
                    words = alnum_words(data)
                    rows, items = searchers.spans(words)
                    n_words[k] = len(words)
                    if rows:
                        spans[k] += np.array(rows, np.int64).tobytes()
                        names[k] |= items
                del searchers
            ids = pa.chunked_array([batch.column("doc_id") for batch in group]).combine_chunks()
            ids = ids if isinstance(ids, pa.Array) else ids.chunk(0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(spans, pa.binary()), pa.array(map(sorted, names), pa.list_(pa.string()))], names=["doc_id", "n_words", "_spans", "_items"]
            )

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [hit_words(np.frombuffer(x, np.int64).reshape(-1, 2)) for x in batch.column("_spans").to_pylist()]
        items = batch.column("_items").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([x > 0 for x in hit]),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, numbers, texts = [], [], []
            for item, data in zip(batch.column("item").to_pylist(), binary_column(batch, "text"), strict=True):
                words = alnum_words(data)
                for number, start in enumerate(range(0, max(1, len(words) - window + 1), PIECE)):
                    items.append(item)
                    numbers.append(number)
                    texts.append(b" ".join(words[start : start + PIECE + window - 1]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], names=["item", "number", "text"])

    return run


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(pieces of the items with the column block, number of blocks of about `block_bytes` bytes of text each).

    A piece has the words of its item, or of a part of it, that share no window with any other piece.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = checkpointed(items.mapInArrow(_pieces(window), "item string, number long, text string").distinct())
    total = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    return pieces.withColumn("block", F.pmod(F.xxhash64("item", "number", "text"), F.lit(blocks))), blocks


def block_files(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Files with the searchers of the benchmark's blocks, each built by one task, in the shared folder.

    They stay there, as what reads them may run at any time; a task that is repeated writes one of its own.
    """
    pieces, _ = benchmark_blocks(benchmark, window, block_bytes)
    folder = shared_folder(benchmark.sparkSession)
    folder = f"{folder if ':' in folder else 'file://' + os.path.abspath(folder)}/patterns-{uuid.uuid4().hex}"

    def build(own: pd.DataFrame) -> pd.DataFrame:
        searchers = Searchers([(item, text.encode()) for item, text in zip(own["item"], own["text"], strict=True)], window)
        store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))
        store.create_dir(name, recursive=True)
        path = f"{name}/{uuid.uuid4().hex}"
        with store.open_output_stream(path) as out:
            out.write(pickle.dumps(searchers, 5))
        return pd.DataFrame({"path": [f"{re.sub('^file:/+', 'file:///', folder)}/{path.rpartition('/')[2]}"]})

    built = checkpointed(pieces.groupBy("block").applyInPandas(build, "path string"))  # so that no later read builds anew
    return [row["path"] for row in built.collect()]  # one row per block


_FOUND = "n_words long, _spans binary, _items array<string>"


def search_benchmark(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, _spans (int64 word ranges) and _items (ids as strings) of each row.

    A null text has no words. An item whose id is null marks words but is not counted as an item.
    Repeated rows are judged one by one.
    """
    paths = block_files(benchmark, window, block_bytes)
    return documents.select("doc_id", "text").mapInArrow(_search(paths, window), f"doc_id long, {_FOUND}")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row of `documents`.

    Null or wordless texts: 0 words, 0 hits, the hash of the empty string, not contaminated. An
    empty benchmark contaminates nothing. Further columns of either table are not looked at.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return search_benchmark(docs, benchmark, window, block_bytes).mapInArrow(_digest, RESULT)


def _keep_clean(paths: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(paths)
        for group in _groups(batches, blocks.group):
            texts = [data for batch in group for data in binary_column(batch, "text")]
            clean = np.ones(len(texts), bool)
            for searchers in blocks:
                for k in np.flatnonzero(clean):
                    clean[k] = not searchers.occur(alnum_words(texts[k]))
                del searchers
            done = 0
            for batch in group:
                for start in range(0, batch.num_rows, ROWS_OUT):  # whole rows go out in small batches
                    part = batch.slice(start, ROWS_OUT)
                    yield part.filter(pa.array(clean[done : done + part.num_rows]))
                    done += part.num_rows

    return run


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `documents` that share no window with the benchmark, all columns kept.

    Null, empty and wordless texts stay, repeated rows are judged each for itself, and with an empty
    benchmark or empty documents every row stays.
    """
    bounded_batches(documents.sparkSession)
    paths = block_files(benchmark, window, block_bytes)
    return documents.mapInArrow(_keep_clean(paths), documents.schema) if paths else documents


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS m FROM item WHERE len(w) > 0),
pattern AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM sized, unnest(range(1, len(w) - m + 2)) AS u(i)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT m FROM pattern),
windows AS (
  SELECT r, m, i, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM doc, lengths, unnest(range(1, len(w) - m + 2)) AS u(i)),
hits AS (SELECT r, i, m, item_id FROM windows JOIN pattern USING (m, p)),
words AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + m)) AS j FROM hits) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
  coalesce(words.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
