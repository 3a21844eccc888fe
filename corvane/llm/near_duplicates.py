"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has one bit per column of the 64-bit shingle hashes, set if over half of them set
it. Texts link at `LIMIT` = 2 or fewer differing bits, and the operator returns the connected
component of every row.

Equal fingerprints are merged first (a map-side combined group-by), so groups of exact copies
cost one row. The distinct fingerprints are cut into a ring of m = 2 k + 1 segments. If two of them
differ in at most 2 bits, the pigeonring principle promises a start segment from which every chain
of l consecutive segments has at most l * 2 / m differing bits in total: none over the first k
segments, one over the next k, two over the whole ring. The first k segments form the bucket key,
the longer chains prune inside the bucket, and only survivors get the full Hamming check. The ring
grows with the number of distinct fingerprints (`ring_size`), so that buckets stay small: k = 2
gives keys of 25 bits, k = 4 of 28 and k = 8 of 30.

Buckets are counted before they are gathered. Those of at most `bucket_limit` fingerprints are
compared inside one row and emit a spanning forest of their links, never all pairs. Larger ones,
which one family of near copies may cause, are linked through their single-bit variants: x and y
differ in at most 2 bits just if flipping at most one bit of each can make them equal, so grouping
the variants and linking each group to its smallest member gives the same components with 65 small
rows per fingerprint and no bound on the bucket.

Components come from alternating large-star and small-star rounds over the edge table, each round
cut by a reliable checkpoint. Nothing but counters reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corvane.llm.idsets import suspects
from corvane.llm.words import ROWS_OUT, ascii_lower, binary_column, blank_words
from corvane.session import bounded_batches, checkpointed
from corvane.sources.tables import table

SHINGLE = 3
LIMIT = 2
#: Numbers of segments that a ring may have, and how many fingerprints a bucket should have on average at most.
RINGS, FILL = (5, 9, 17), 64
BUCKET_LIMIT = 512
#: A fingerprint that more than one in that many rows have is hot.
HOT = 1000
SEED = 42


def fingerprint(data: bytes, size: int = SHINGLE) -> int:
    """64-bit SimHash of a text; 0 for a text without words."""
    words = blank_words(ascii_lower(data))
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest = xxhash.xxh64_intdigest
    columns = [words[k : len(words) - size + 1 + k] for k in range(size)]
    hashes = np.fromiter((digest(s, SEED) for s in map(b" ".join, zip(*columns, strict=True))), np.uint64, len(words) - size + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [signed(fingerprint(data)) for data in binary_column(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], names=["doc_id", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row; fp as a signed long."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_fingerprints, "doc_id long, fp long")


def ring(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments that cut 64 bits."""
    edges = [64 * k // segments for k in range(segments + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def ring_size(prints: int) -> int:
    """The smallest ring whose keys spread that many fingerprints over buckets of FILL; else the largest."""
    return next((m for m in RINGS if prints <= FILL << 64 * (m // 2) // m), RINGS[-1])


def ring_keys(prints: DataFrame, segments: int) -> DataFrame:
    """(fp, start, key): one row per ring start, the key being its first segments // 2 segments."""
    cuts = ring(segments)

    def key(start: int):
        parts = F.lit(0).cast("long")
        for step in range(segments // 2):
            low, width = cuts[(start + step) % segments]
            part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
            parts = F.shiftleft(parts, width).bitwiseOR(part)
        return parts

    keys = [F.struct(F.lit(k).alias("start"), key(k).alias("key")) for k in range(segments)]
    return prints.select("fp", F.inline(F.array(*keys)))


_BITS = np.array([bin(x).count("1") for x in range(1 << 16)], np.uint8)


def bit_count(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.uint64)
    return sum(_BITS[(values >> np.uint64(shift)) & np.uint64(0xFFFF)].astype(np.int64) for shift in (0, 16, 32, 48))


def chain_holds(differences: np.ndarray, start: int, segments: int) -> np.ndarray:
    """Whether each chain from `start` of the XORed fingerprints stays within its budget."""
    cuts = ring(segments)
    total = np.zeros(differences.shape, np.int64)
    holds = np.ones(differences.shape, bool)
    for length in range(1, segments + 1):
        low, width = cuts[(start + length - 1) % segments]
        total += bit_count((differences >> np.uint64(low)) & np.uint64((1 << width) - 1))
        holds &= total * segments <= length * LIMIT
    return holds


def bucket_edges(members: np.ndarray, start: int, segments: int) -> list[tuple[int, int]]:
    """A spanning forest of the links that pass the chain filter from `start` (signed ids)."""
    values = members.astype(np.int64).view(np.uint64)
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for i in range(len(values) - 1):
        xor = values[i + 1 :] ^ values[i]
        near = np.flatnonzero(chain_holds(xor, start, segments))
        for j in near[bit_count(xor[near]) <= LIMIT] + i + 1:
            a, b = find(i), find(int(j))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((int(members[i]), int(members[j])))
    return edges


def _bucket_edges(segments: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            edges = [
                edge
                for start, members in zip(frame["start"], frame["members"], strict=True)
                for edge in bucket_edges(np.sort(np.asarray(members)), int(start), segments)
            ]
            yield pd.DataFrame(edges, columns=["u", "v"], dtype="int64")

    return run


def links(prints: DataFrame, bucket_limit: int = BUCKET_LIMIT, segments: int | None = None) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect just those within LIMIT bits.

    `segments` of the ring follow the number of fingerprints if not given.
    """
    segments = segments or ring_size(prints.count())
    keyed = ring_keys(prints, segments)
    counted = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    large = checkpointed(counted.where(F.col("n") > bucket_limit).select("start", "key"))
    some_large = not large.isEmpty()
    small = keyed
    if some_large:
        small = keyed.join(large, ["start", "key"], "left_anti")
    gathered = small.groupBy("start", "key").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    edges = gathered.select("start", "members").mapInPandas(_bucket_edges(segments), "u long, v long")
    if some_large:
        hot = keyed.join(large, ["start", "key"], "left_semi").select("fp").distinct()
        flips = F.array(F.lit(0).cast("long"), *(F.lit(signed(1 << k)) for k in range(64)))
        variants = hot.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
        least = variants.groupBy("at").agg(F.min("fp").alias("u"))
        edges = edges.unionByName(variants.join(least, "at").where("u <> fp").select("u", F.col("fp").alias("v")))
    return edges


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(v, u): for each vertex but the smallest of its component, that smallest vertex.

    Alternates large-star (larger neighbours to the smallest neighbour) and small-star (smaller
    neighbours and the vertex itself to the smallest) until the edge table no longer changes.
    """

    def stars(frame: DataFrame, large: bool) -> DataFrame:
        if large:
            around = frame.select("u", "v").unionByName(frame.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            around = frame.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = around.join(least, "u")
        if large:
            return joined.where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        own = least.select(F.col("m").alias("u"), F.col("u").alias("v"))
        return joined.select(F.col("m").alias("u"), "v").unionByName(own).where("u <> v").distinct()

    frame = checkpointed(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        state = frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return frame.select("v", "u")
        before = state
        frame = checkpointed(stars(stars(frame, True), False))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(documents: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of `documents`.

    A null, empty or blank text has fingerprint 0 and links like any other. Repeated rows share
    their component; a null doc_id belongs to one but never names it, unless all its ids are
    null: then component_id is null. Other columns are not looked at.
    """
    columns = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    return placed_rows(documents, bucket_limit).select("doc_id", *columns)


def placed_rows(documents: DataFrame, bucket_limit: int) -> DataFrame:
    """doc_id, fp, root (the component itself) and component_id (its least id, which two components can share).

    Rows meet their fingerprint's component by a join. Fingerprints of more than one in HOT rows,
    of which there can be HOT at most, are broadcast, so no key of the shuffled rest is hot.
    """
    rows = checkpointed(fingerprints(documents))
    prints = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    found = components(links(prints.select("fp"), bucket_limit))
    placed = prints.join(found, F.col("fp") == F.col("v"), "left").select("fp", "least", "n", F.coalesce("u", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = checkpointed(placed.select("fp", "n", "root").join(named, "root").select(F.col("fp").alias("_fp"), "n", "root", "component_id"))
    many = F.col("n") > rows.count() / HOT
    hot = F.broadcast(of_print.where(many))  # HOT rows at most
    columns = "doc_id", "fp", "root", "component_id"
    common = rows.join(hot, F.col("fp") == F.col("_fp")).select(*columns)
    rare = rows.join(hot.select("_fp"), F.col("fp") == F.col("_fp"), "left_anti")
    return common.unionByName(rare.join(of_print.where(~many), F.col("fp") == F.col("_fp")).select(*columns))


def one_of_each_group(documents: DataFrame, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """One row of each component of `documents`, all columns kept: the row of its component_id.

    Rows of a component that repeat its id are the same document: of them the one with the smallest
    values stays. Rows without an id can neither stand for a group nor be named as copies: they stay.
    Rows of one id with different texts go or stay each with its own component. An empty table stays empty.

    The plan is the same at every size. Ids that occur once and stand for their component need no
    decision. Rows of the other ids, and those few that a filter of fixed size can't tell from them,
    are fingerprinted once more, merged by id and fingerprint and looked up among those that stand.
    """
    found = checkpointed(placed_rows(documents, bucket_limit))
    named = found.where("doc_id is not null")
    unsure = named.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(F.col("doc_id") != F.col("component_id")).alias("copy"))
    several, single = suspects(documents, "doc_id", checkpointed(unsure.where("n > 1 or copy").select("doc_id")))
    bounded_batches(documents.sparkSession)
    whole = several.select(F.struct(*(f"`{c}`" for c in documents.columns)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = StructType([whole.schema["row"], StructField("doc_id", LongType()), StructField("fp", LongType())])
    merged = whole.mapInArrow(_fingerprinted_rows, schema).groupBy("doc_id", "fp").agg(F.min("row").alias("row"))
    stand = named.where("doc_id = component_id").select("doc_id", "fp", "root").distinct()
    kept = merged.join(stand.hint("merge"), ["doc_id", "fp"]).groupBy("root").agg(F.min("row").alias("row"))
    return single.unionByName(kept.select("row.*"))


def _fingerprinted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_OUT):  # whole rows go out in small batches
            part = batch.slice(start, ROWS_OUT)
            prints = [signed(fingerprint(data)) for data in binary_column(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array(prints, pa.int64())], names=["row", "doc_id", "fp"])


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
