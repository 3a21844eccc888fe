"""Removal of long repeated strings with run-length compressed Burrows-Wheeler indexes.

A byte goes if a string of `LENGTH` bytes that covers it also starts anywhere else. Documents are
compared by content, never each with each:

1. A window of LENGTH bytes has a minimum: the least hash of the `GRAM` bytes strings in it. Equal windows
   have equal minima. Consecutive windows with one minimum form a stretch of about half a window more than
   LENGTH bytes. Minima that occur at one place only can't be of a repeated window; they are dropped by a
   map-side combined aggregation of two numbers each, before any text moves.
   A stretch that may hold one window twice counts as two places.
2. Stretches that remain are merged by content, so a passage that a third of the documents share is one
   string with the mark that it has several places.
3. Strings that share a minimum come together in one block of at most some BLOCK bytes. Of each block a task
   builds the Burrows-Wheeler transform, keeps it as runs, and stores at the ends of each run the position
   in the text and the length of the match with the neighbour beyond that end. Between two such samples the
   longest match of a position with any other one falls by exactly 1 a byte, so one pass over the samples
   streams the matching statistics of the whole block, and windows that match LENGTH bytes are marked.
4. Marks go back to the places of their strings, are joined with the texts by their hash, and those bytes go.

Texts that occur twice and are long enough go as a whole, and only one of them takes part in the search. A
minimum whose different strings have more than GROUP bytes, which a passage of hardly more than LENGTH bytes in
very many surroundings can cause, would not fit a block: its windows are hashed and counted one by one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.llm.idsets import suspects
from corvane.session import bounded_batches, checkpointed, shared_folder
from corvane.sources.tables import table

LENGTH = 200
#: Bytes of the strings whose hashes are compared for the minimum.
GRAM = 50
#: Bytes at which a block is closed, and bytes of the different strings of one minimum at most: a group stays in one
#: block, so a block has less than their sum.
BLOCK, GROUP = 3 << 18, 1 << 20
#: Windows of one stretch at most, and windows that are hashed at a time.
STRETCH, PIECE = 2048, 1 << 18
#: Between the strings of a block; no UTF-8 text has this byte.
SEPARATOR = b"\xff"
_STEP = 0x9E3779B97F4A7C15
EMPTY = hashlib.sha256(b"").hexdigest()


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all strings of `size` consecutive bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    part, width, factor = data.astype(np.uint64) + np.uint64(1), 1, np.uint64(_STEP)
    whole, done = None, 0
    with np.errstate(over="ignore"):
        for bit in range(size.bit_length()):
            if size >> bit & 1:  # strings of `done` bytes, then strings of `width` bytes behind them
                keep = len(data) - done - width + 1
                whole = part if whole is None else whole[:keep] * factor + part[done : done + keep]
                done += width
            if size >> (bit + 1):
                keep = len(data) - 2 * width + 1
                part, width, factor = part[:keep] * factor + part[width : width + keep], 2 * width, factor * factor
        mixed = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(32))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values, reach = np.minimum(values[:-reach], values[reach:]), 2 * reach
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, first window, number of windows, whether it may repeat itself) of runs of windows with one minimum.

    Two equal windows of one stretch hold the minimum at the same places of their own, so it must enter a window behind
    the first one of the stretch by that window's last string; no other stretch repeats itself.
    """
    found = []
    for begin in range(0, len(data) - length + 1, PIECE):
        piece = np.frombuffer(data, np.uint8, min(PIECE + length - 1, len(data) - begin), begin)
        hashes = gram_hashes(piece, gram)
        least = sliding_minimum(hashes, length - gram + 1)
        new = np.append(True, least[1:] != least[:-1])
        again = (hashes[length - gram :] == least) & ~new
        first = np.union1d(np.flatnonzero(new), np.arange(0, len(least), STRETCH))
        found.append((least[first].view(np.int64), first + begin, np.diff(np.append(first, len(least))), np.logical_or.reduceat(again, first)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(np.zeros(0, np.int64) for _ in range(4))


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of a text with samples at both ends of every run.

    heads, lengths: the runs (256 is the mark before the text's first byte). below_at, above_at: positions in the text
    of the first and the last suffix of each run, ascending; below, above: how many bytes these have in common with the
    suffix sorted before, and after, them.
    """

    LEAF = 8

    def __init__(self, text: np.ndarray):
        size = len(text)
        self.size = size
        order, levels = self._sorted(text)
        before = np.where(order > 0, text[order - 1].astype(np.int16), 256)
        starts = np.concatenate(([0], np.flatnonzero(before[1:] != before[:-1]) + 1)) if size else np.zeros(0, np.int64)
        self.heads, self.lengths = before[starts], np.diff(np.append(starts, size))
        ends = starts + self.lengths - 1
        common = self._common(text, levels, order[starts[1:] - 1], order[starts[1:]])
        self.below_at, self.below = self._by_place(order[starts], np.concatenate(([0], common))[: len(starts)])
        self.above_at, self.above = self._by_place(order[ends], np.append(common, 0)[: len(ends)])

    @staticmethod
    def _by_place(places: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turn = np.argsort(places)
        return places[turn], values[turn]

    @classmethod
    def _sorted(cls, text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Positions by suffix, and per level (bytes, rank of every position by that many bytes).

        Each round sorts only the positions that are still tied, by three ranks of the round before.
        """
        size = len(text)
        if size >= 1 << 21:
            raise ValueError("ranks of a longer text don't fit three to a long")
        key = np.zeros(size, np.uint64)
        padded = np.append(text, np.zeros(cls.LEAF, np.uint8)).astype(np.uint64)
        for k in range(cls.LEAF):
            key = (key << np.uint64(8)) | padded[k : k + size]
        order = np.argsort(key)
        key = key[order]
        rank = np.zeros(size + 1, np.int64)  # the last place, of rank 0, is the end of the text
        slots = np.arange(size)
        new = np.append(True, key[1:] != key[:-1]) if size else np.zeros(0, bool)
        rank[order] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
        depth, levels, tied = cls.LEAF, [(cls.LEAF, rank.astype(np.int32))], cls._ties(new)
        while tied.any():
            slots = slots[tied]
            at = order[slots]
            key = (rank[at] << 42) | (rank[np.minimum(at + depth, size)] << 21) | rank[np.minimum(at + 2 * depth, size)]
            turn = np.argsort(key)
            key, at = key[turn], at[turn]
            order[slots] = at
            new = np.append(True, key[1:] != key[:-1])
            rank[at] = np.maximum.accumulate(np.where(new, slots, 0)) + 1
            depth, tied = 3 * depth, cls._ties(new)
            levels.append((depth, rank.astype(np.int32)))
        return order, levels

    @staticmethod
    def _ties(new: np.ndarray) -> np.ndarray:
        """Which of the sorted ones are equal to a neighbour."""
        return ~(new & np.append(new[1:], True))

    @staticmethod
    def _common(text: np.ndarray, levels: list[tuple[int, np.ndarray]], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many bytes each pair of suffixes has in common."""
        size, count = len(text), np.zeros(len(left), np.int64)
        for depth, rank in reversed(levels):
            for _ in range(2):
                a, b = left + count, right + count
                same = (rank[np.minimum(a, size)] == rank[np.minimum(b, size)]) & (np.maximum(a, b) < size)
                count += depth * same
        going = np.ones(len(left), bool)
        for _ in range(RunLengthIndex.LEAF - 1):
            a, b = left + count, right + count
            going &= np.maximum(a, b) < size
            going &= text[np.minimum(a, size - 1)] == text[np.minimum(b, size - 1)]
            count += going
        return count

    def matching_statistics(self, stretch: int = 1 << 20) -> Iterator[np.ndarray]:
        """Stretch after stretch of the text: how long the longest match of each position with any other one is."""
        for begin in range(0, self.size, stretch):
            at = np.arange(begin, min(begin + stretch, self.size))
            best = np.zeros(len(at), np.int64)
            for places, values in ((self.below_at, self.below), (self.above_at, self.above)):
                last = np.searchsorted(places, at, "right") - 1
                best = np.maximum(best, values[last] - (at - places[last]))
            yield best


def marked_windows(strings: list[bytes], several: list[bool], length: int = LENGTH) -> list[np.ndarray]:
    """For each string the first windows and the ends of runs of windows that occur elsewhere, as an (n, 2) array.

    `several` tells which strings have more than one place, so that all their windows do.
    """
    text = np.frombuffer(SEPARATOR.join(strings) + SEPARATOR, np.uint8)
    sizes = np.array([len(s) for s in strings])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    statistics = np.concatenate(list(RunLengthIndex(text).matching_statistics()))
    step = np.zeros(len(text) + 1, np.int64)  # windows begin in begins .. begins + size - length
    step[begins] += 1
    step[begins + sizes - length + 1] -= 1
    window = np.cumsum(step)[:-1] > 0
    hit = window & ((statistics >= length) | np.repeat(several, sizes + 1))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0]))))
    runs = edges.reshape(-1, 2)
    owner = np.searchsorted(begins, runs[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [runs[a:b] - begins[k] for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def _minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, place): a place is known by its text's hash, so copies of a text have the same ones."""
    for batch in batches:
        for digest, data in zip(batch.column("digest").to_pylist(), _texts(batch), strict=True):
            least, first, _, again = stretches(data)
            with np.errstate(over="ignore"):
                place = first.astype(np.uint64) * np.uint64(_STEP) + np.frombuffer(digest, "<u8", 1)
            if again.any():  # one more place of its own
                least, place = np.append(least, least[again]), np.append(place, ~place[again])
            yield pa.RecordBatch.from_arrays([pa.array(least), pa.array(place.view(np.int64))], names=["h", "place"])


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (value.as_py() for value in batch.column("data"))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, digest, first, windows) of all stretches; a text once in a task as far as SEEN hashes tell."""
    seen: set[bytes] = set()
    for batch in batches:
        for digest, data in zip(batch.column("digest").to_pylist(), _texts(batch), strict=True):
            if digest in seen:
                continue
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(digest)
            least, first, windows, _ = stretches(data)
            digests = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(first), np.int32)), pa.array([digest], pa.binary())).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(least), digests, pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32))],
                names=["h", "digest", "first", "windows"],
            )


#: Hashes that a task remembers to hand on what it repeats only once; beyond that it forgets, and more moves.
SEEN = 200_000


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, string, digest, first, bytes): the bytes of a string once in a task as far as SEEN hashes tell, else null."""
    seen: set[bytes] = set()
    for batch in batches:
        digests, stretch = batch.column("digest").to_pylist(), batch.column("stretch").to_pylist()
        for digest, data, parts in zip(digests, _texts(batch), stretch, strict=True):
            rows = []
            for part in parts:
                piece = data[part["first"] : part["first"] + part["windows"] + LENGTH - 1]
                name = hashlib.blake2b(piece, digest_size=16).digest()
                rows.append((part["h"], name, digest, part["first"], None if name in seen else piece))
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()))],
                names=["h", "string", "digest", "first", "bytes"],
            )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(string, runs) from rows sorted by h: whole groups gather to blocks, each is indexed and streamed."""
    names: list[bytes] = []
    texts: list[bytes] = []
    several: list[bool] = []
    group: list[tuple[bytes, bytes, bool]] = []
    size, now = 0, None
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def output(found: list[tuple[bytes, np.ndarray]]) -> pa.RecordBatch:
        found = [(n, r) for n, r in found if len(r)]
        lists = pa.array([[{"begin": a, "end": b} for a, b in runs.tolist()] for _, runs in found], kind)
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.binary()), lists], names=["string", "runs"])

    def close() -> list[tuple[bytes, np.ndarray]]:
        """Ends the group; one string alone with several places needs no index, as all its windows have them too."""
        nonlocal size
        whole = []
        if len(group) == 1 and group[0][2]:
            whole = [(group[0][0], np.array([[0, len(group[0][1]) - LENGTH + 1]]))]
        else:
            for name, data, often in group:
                names.append(name)
                texts.append(data)
                several.append(often)
                size += len(data) + 1
        group.clear()
        return whole

    alone: list[tuple[bytes, np.ndarray]] = []
    for batch in batches:
        for h, name, data, often in zip(*(batch.column(c).to_pylist() for c in ("h", "string", "bytes", "several")), strict=True):
            if h != now:
                alone += close()
                now = h
                if size >= BLOCK:
                    yield output(list(zip(names, marked_windows(texts, several), strict=True)))
                    names, texts, several, size = [], [], [], 0
                if len(alone) >= 10_000:
                    yield output(alone)
                    alone = []
            group.append((name, data, often))
    alone += close()
    if names:
        alone += zip(names, marked_windows(texts, several), strict=True)
    if alone:
        yield output(alone)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, n_removed, n_spans, kept_sha256) of texts with the runs of bytes that go."""
    for batch in batches:
        rows = []
        for digest, data, runs in zip(batch.column("digest").to_pylist(), _texts(batch), batch.column("gone").to_pylist(), strict=True):
            kept, removed, spans, end = hashlib.sha256(), 0, 0, 0
            for begin, stop in sorted((r["begin"], r["end"]) for r in runs):
                if begin > end or not spans:
                    kept.update(data[end:begin])
                    removed, spans, end = removed + stop - begin, spans + 1, stop
                elif stop > end:
                    removed, end = removed + stop - end, stop
            kept.update(data[end:])
            rows.append((digest, removed, spans, kept.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64(), pa.string()))],
            names=["digest", "n_removed", "n_spans", "kept_sha256"],
        )


def _of_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each text of `wanted` once, (digest, data), with the other columns of `wanted`.

    Only texts that a filter of fixed size can't clear move, and copies are merged before they do.
    """
    named = keyed.withColumn("id", F.xxhash64("digest"))
    maybe, _ = suspects(named, "id", wanted.select(F.xxhash64("digest").alias("id")))
    return maybe.groupBy("digest").agg(F.first("data").alias("data")).join(wanted, "digest")


def _counted_windows(strings: DataFrame) -> DataFrame:
    """(string, runs) for strings of groups that no block could hold: each window is hashed and counted by itself."""
    windows = strings.select("string", "several", "bytes", F.explode(F.expr(f"sequence(0, length(bytes) - {LENGTH})")).alias("begin"))
    hashed = windows.select("string", "several", "begin", F.unhex(F.sha2(F.expr(f"substring(bytes, begin + 1, {LENGTH})"), 256)).alias("window"))
    place = F.xxhash64("string", "begin")
    counted = hashed.groupBy("window").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("several").alias("several"))
    repeated = checkpointed(counted.where("a <> b or several").select("window"))  # a plain side, so that a skewed join can be split
    nth = F.row_number().over(Window.partitionBy("string").orderBy("begin"))
    islands = hashed.join(repeated, "window").select("string", "begin", (F.col("begin") - nth).alias("island"))
    runs = islands.groupBy("string", "island").agg(F.min("begin").alias("begin"), (F.max("begin") + 1).alias("end"))
    return runs.groupBy("string").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))


def repeated_runs(keyed: DataFrame, group: int = GROUP) -> DataFrame:
    """(digest, gone: runs of bytes covered by repeated strings) of texts with any, from (digest, data) with copies or not."""
    spark = keyed.sparkSession
    bounded_batches(spark)
    folder = f"{shared_folder(spark)}/stretches-{uuid.uuid4().hex}"
    minima = keyed.mapInArrow(_minima, "h long, place long").groupBy("h").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    often = checkpointed(minima.where("a <> b").select("h"))
    maybe, _ = suspects(keyed.mapInArrow(_places, "h long, digest binary, first int, windows int"), "h", often)
    places = checkpointed(maybe.join(often, "h").groupBy("digest").agg(F.collect_set(F.struct("first", "h", "windows")).alias("stretch")))
    _of_texts(keyed, places).mapInArrow(_strings, "h long, string binary, digest binary, first int, bytes binary").write.parquet(folder)
    stored = spark.read.schema("h long, string binary, digest binary, first int, bytes binary").parquet(folder)
    place = F.xxhash64("digest", "first")
    strings = stored.groupBy("h", "string").agg(F.max("bytes").alias("bytes"), (F.min(place) != F.max(place)).alias("several"))
    sizes = stored.groupBy("h", "string").agg(F.max(F.length("bytes") + 1).alias("n"))
    crowded = checkpointed(sizes.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > group).select("h"))
    rest, counted = strings, None
    if not crowded.isEmpty():
        rest, counted = strings.join(crowded, "h", "left_anti"), _counted_windows(strings.join(crowded, "h", "left_semi"))
    marks = rest.repartition("h").sortWithinPartitions("h").mapInArrow(_indexed, "string binary, runs array<struct<begin: int, end: int>>")
    marks = marks if counted is None else marks.unionByName(counted)
    in_text = F.expr(f"transform(runs, r -> struct(first + r.begin as begin, first + r.end + {LENGTH - 1} as end))")
    gone = stored.select("string", "digest", "first").join(marks, "string").select("digest", in_text.alias("runs"))
    result = checkpointed(gone.groupBy("digest").agg(F.flatten(F.collect_list("runs")).alias("gone")))
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return result


def without_repeats(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of `documents`.

    A null text is empty; texts under LENGTH bytes lose nothing. Repeated rows are places of their own, so a text of
    LENGTH bytes or more that occurs twice, under whatever ids, null included, goes as a whole. Other columns are not
    looked at. An empty table gives an empty one.
    """
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    whole = F.unhex(F.sha2("data", 256))
    rows = rows.select("doc_id", "data", F.length("data").cast("long").alias("n_bytes"), whole.alias("whole"), F.substring(whole, 1, 16).alias("digest"))
    keyed = rows.where(F.col("n_bytes") >= LENGTH).select("digest", "data")
    counted = rows.where(F.col("n_bytes") >= LENGTH).groupBy("digest").agg(F.count("*").alias("n"), F.min("n_bytes").alias("n_removed"))
    copies = checkpointed(counted.where("n > 1").select("digest", "n_removed", F.lit(1).cast("long").alias("n_spans"), F.lit(EMPTY).alias("kept_sha256")))
    gone = repeated_runs(keyed, group).join(copies.select("digest"), "digest", "left_anti")
    cut = _of_texts(keyed, gone).mapInArrow(_cut, "digest binary, n_removed long, n_spans long, kept_sha256 string")
    changed = copies.unionByName(cut)
    nothing = F.lit(0).cast("long")
    return (
        rows.select("doc_id", "n_bytes", "whole", "digest")
        .join(changed, "digest", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", nothing).alias("n_removed"),
            F.coalesce("n_spans", nothing).alias("n_spans"),
            F.coalesce("kept_sha256", F.lower(F.hex("whole"))).alias("kept_sha256"),
        )
    )


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
