"""Graphs of records: bounded as-of retrieval, reach, taxonomy tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvane.operators.comparing import all_valid, as_of
from corvane.session import checkpointed

STATUSES = ("observed", "validated")


def valid_parts(nodes: DataFrame, edges: DataFrame, evidence: DataFrame, claims: DataFrame, moment: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evidence, claims, edges) that were known at the moment, have a good status and only valid evidence."""
    known = evidence.where(as_of(F.col("observed_at"), moment))
    valid = known.groupBy("record_id").agg(F.collect_set("id").alias("_valid"))

    def checked(frame: DataFrame) -> DataFrame:
        ok = frame.where(F.col("status").isin(*STATUSES) & as_of(F.col("known_at"), moment)).join(valid, "record_id", "left")
        none = F.array().cast("array<string>")
        return ok.where(all_valid(F.col("evidence_ids"), F.coalesce("_valid", none))).drop("_valid")

    return known, checked(claims), checked(edges)


def retrieve(nodes: DataFrame, edges: DataFrame, max_hops: int = 2, max_nodes: int = 10) -> DataFrame:
    """Per record: nodes and edges reached from its first `max_nodes` nodes, breadth first.

    nodes: (record_id, ord, id); edges: (record_id, ord, id, source, target), both valid already.
    Edges count both ways. A record's rows meet once, as arrays. An edge is kept if both its ends were
    visited; lack of room marks the record as truncated.

    A record of up to `max_nodes` node rows starts with all its nodes, so the walk finds more only where
    the first rows repeat an id: each step visits the neighbours, sorted, of the nodes that the step
    before added, while there is room.
    """
    none = F.lit(None).cast("string")
    both = nodes.select("record_id", "ord", "id", none.alias("source"), none.alias("target"), F.lit(True).alias("node")).unionByName(
        edges.select("record_id", "ord", "id", "source", "target", F.lit(False).alias("node"))
    )
    placed = lambda *fields: F.struct(F.col("ord").isNull().alias("last"), "ord", *fields)
    records = both.groupBy("record_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("node"), placed("id")))).alias("_nodes"),
        F.array_sort(F.collect_list(F.when(~F.col("node"), placed("id", "source", "target")))).alias("links"),
    )
    records = records.select("record_id", F.transform("_nodes", lambda n: n["id"]).alias("ids"), "links")
    first = F.array_distinct(F.slice("ids", 1, max_nodes))
    records = records.withColumn("seen", first).withColumn("_new", F.when((F.size("ids") > max_nodes) & (F.size("seen") < max_nodes), F.col("seen")).otherwise(F.array().cast("array<string>")))

    def visited(seen: Column, at: Column) -> Column:
        away = F.filter("links", lambda e: (e["source"] == at) | (e["target"] == at))
        ends = F.transform(away, lambda e: F.when(e["source"] == at, e["target"]).otherwise(e["source"]))
        fresh = F.array_except(F.array_intersect(F.array_sort(ends), F.col("ids")), seen)
        return F.slice(F.concat(seen, fresh), 1, max_nodes)

    for _ in range(max_hops):
        records = records.withColumn("_more", F.aggregate("_new", F.col("seen"), visited))
        records = records.withColumn("_new", F.array_except("_more", "seen")).withColumn("seen", F.col("_more"))
    kept = F.filter("links", lambda e: F.array_contains("seen", e["source"]) & F.array_contains("seen", e["target"]))
    return records.select("record_id", F.col("seen").alias("nodes"), F.transform(kept, lambda e: e["id"]).alias("edges"), (F.size("ids") > max_nodes).alias("truncated"))


def kept_evidence(found: DataFrame, edges: DataFrame, claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence (record_id, id, ...) that an edge which `found` keeps, or a valid claim of a found record, cites.

    found: the result of `retrieve`; edges and claims: (record_id, id, evidence_ids), valid ones.
    """
    kept = found.select("record_id", F.explode("edges").alias("id")).join(edges, ["record_id", "id"]).select("record_id", F.explode("evidence_ids").alias("id"))
    claimed = claims.join(found.select("record_id"), "record_id", "left_semi").select("record_id", F.explode("evidence_ids").alias("id"))
    return evidence.join(kept.unionByName(claimed).distinct(), ["record_id", "id"], "left_semi")


def answer(seeds: DataFrame, nodes: DataFrame, edges: DataFrame, evidence: DataFrame, claims: DataFrame, moment: str | None = None, max_hops: int = 2, max_nodes: int = 10) -> DataFrame:
    """Records that a search found (seeds: record_id, rank), with what was known of them at a moment.

    record_id, rank, nodes, edges, truncated of the bounded walk, and the ids of the claims and of the evidence that kept
    edges and claims cite, sorted.
    """
    own = lambda frame: frame.join(seeds.select("record_id"), "record_id", "left_semi")
    known, good_claims, good_edges = valid_parts(own(nodes), own(edges), own(evidence), own(claims), moment)
    found = retrieve(own(nodes), good_edges, max_hops, max_nodes)
    ids = lambda frame, name: frame.groupBy("record_id").agg(F.array_sort(F.collect_set("id")).alias(name))
    none = F.array().cast("array<string>")
    cited = ids(kept_evidence(found, good_edges, good_claims, known), "evidence")
    joined = seeds.join(found, "record_id", "left").join(ids(good_claims, "claims"), "record_id", "left").join(cited, "record_id", "left")
    filled = {c: F.coalesce(c, none) for c in ("nodes", "edges", "claims", "evidence")} | {"truncated": F.coalesce("truncated", F.lit(False))}
    return joined.withColumns(filled).orderBy("rank", "record_id")


def iterate(search: Callable[[str], DataFrame], query: str, limit: int = 5, follow_ups: int = 2) -> DataFrame:
    """The best `limit` results of a query and of its follow-ups: id, call, rank, evidence, paths, claims.

    search gives (id, rank, evidence, paths, claims) with distinct ids; the last three are arrays of
    structs with an id, those of paths with source and target. The follow-ups are the first endpoints
    of the first call's paths in order of text, prefix before `:` left out, and are fixed by it, so the
    search cannot feed itself. An id keeps the place where it came first; if it comes again, its
    arrays are united by id, the later call's entry counting, and sorted.
    """
    parts = ("evidence", "paths", "claims")

    def call(number: int, text: str) -> DataFrame:
        return search(text).orderBy("rank", "id").limit(limit).select("id", F.lit(number).alias("call"), "rank", *(F.coalesce(p, F.array()).alias(p) for p in parts))

    found = checkpointed(call(0, query))  # limit rows
    ends = found.select(F.explode("paths").alias("p")).select(F.explode(F.array("p.source", "p.target")).alias("end"))
    texts = ends.select(F.regexp_replace("end", "^[^:]*:", "").alias("text")).where(F.col("text") != query).distinct().orderBy("text").limit(follow_ups)
    for number, row in enumerate(texts.collect(), 1):
        found = found.unionByName(call(number, row["text"]))

    def united(part: str) -> Column:
        calls = F.array_sort(F.collect_list(F.struct("call", F.col(part).alias("v"))))
        entries = F.flatten(F.transform(calls, lambda x: x["v"]))
        ids = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["id"])))
        merged = F.transform(ids, lambda i: F.element_at(F.filter(entries, lambda e: e["id"] == i), -1))
        return F.when(F.count("*") > 1, merged).otherwise(entries).alias(part)

    first = F.min(F.struct("call", "rank"))
    merged = found.groupBy("id").agg(first.alias("first"), *(united(p) for p in parts))
    return merged.select("id", "first.*", *parts).orderBy("call", "rank", "id").limit(limit)


def numbered_roots(seeds: DataFrame) -> DataFrame:
    """(root, part, bit): every distinct seed as one bit of a long; about 32 roots share a part, 64 at most."""
    roots = seeds.select(F.col("node").alias("root")).distinct()
    parts = max(1, roots.count() // 32)
    place = F.row_number().over(Window.partitionBy("slot").orderBy("root")) - 1
    dealt = roots.withColumn("slot", F.pmod(F.xxhash64("root"), F.lit(parts))).withColumn("place", place)
    return dealt.select("root", (F.col("slot") + F.lit(parts) * F.floor(F.col("place") / 64)).alias("part"), (F.col("place") % 64).alias("bit"))


def reach_bits(roots: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """(node, part, hop, bits): the roots of a part that have a node at that least distance, within `hops` undirected steps.

    All roots walk at once. A step joins the frontier with the arcs, which are written once, and bits that meet in a node are
    united before they are shuffled; bits that a node has had leave, so cycles cost nothing. A row stands for up to 64 roots.
    """
    ends = F.array(F.struct("source", "target"), F.struct(F.col("target").alias("source"), F.col("source").alias("target")))
    arcs = checkpointed(edges.select(F.inline(ends)).distinct())
    united = F.bit_or("bits").alias("bits")
    frontier = checkpointed(roots.select(F.col("root").alias("node"), "part", F.expr("shiftleft(1L, cast(bit as int))").alias("bits")).groupBy("node", "part").agg(united))
    had, found = frontier, frontier.withColumn("hop", F.lit(0))
    for hop in range(1, hops + 1):
        step = frontier.join(arcs, F.col("node") == F.col("source")).groupBy(F.col("target").alias("node"), "part").agg(united)
        known = had.select("node", "part", F.col("bits").alias("had"))
        fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("had", F.lit(0).cast("long"))))
        frontier = checkpointed(step.join(known, ["node", "part"], "left").select("node", "part", fresh.alias("bits")).where("bits <> 0"))
        found = found.unionByName(frontier.withColumn("hop", F.lit(hop)))
        if hop < hops:
            had = checkpointed(had.unionByName(frontier).groupBy("node", "part").agg(united))
    return found.select("node", "part", "hop", "bits")


def reach_counts(roots: DataFrame, reached: DataFrame) -> DataFrame:
    """(root, hop, n): how many nodes each root has at each distance, summed bit by bit without a row per root and node."""
    sums = reached.groupBy("part", "hop").agg(*(F.sum(F.expr(f"bit_get(bits, {k})").cast("long")).alias(f"n{k}") for k in range(64)))
    each = F.array(*(F.struct(F.lit(k).alias("bit"), F.col(f"n{k}").alias("n")) for k in range(64)))
    return sums.select("part", "hop", F.inline(each)).where("n > 0").join(roots, ["part", "bit"]).select("root", "hop", "n")


#: Arcs whose ends share one bucket, and rows of reached nodes in one block of roots, about.
BUCKET_ARCS, BLOCK_ROWS = 1 << 23, 1 << 19
LAST = "part long, bit int, n long"


def _last_hop(left: pa.Table, right: pa.Table) -> pa.Table:
    """n of each root of a block: the places of a bucket that the sources of its frontier lead to and that it has not had.

    left: (source, places), each source once; right: (part, bits, source or place), frontier nodes as sources, nodes that
    roots have had as places. Sources with many places are or-ed as bitmaps, others stay lists, so memory follows the arcs.
    """
    lists = left.column("places").combine_chunks()
    starts, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    words = int(flat.max(initial=0)) // 64 + 1
    index = {s: k for k, s in enumerate(left.column("source").to_pylist())}
    spread: list[np.ndarray] = []
    heavy = np.zeros(len(index), bool)
    for k in range(len(index)):
        places = flat[starts[k] : starts[k + 1]]
        heavy[k] = len(places) * 2 >= words
        if heavy[k]:
            marks = np.zeros(words * 64, np.uint8)
            marks[places] = 1
            places = np.packbits(marks, bitorder="little").view(np.uint64)
        spread.append(places)
    parts, bits = right.column("part").to_numpy(), right.column("bits").to_numpy().view(np.uint64)
    at = np.array([-1 if s is None else index.get(s, -2) for s in right.column("source").to_pylist()], np.int64)
    had = right.column("place").fill_null(-1).to_numpy()
    out: list[tuple[int, int, int]] = []
    order = np.argsort(parts, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(parts[order])) + 1) if len(order) else ():
        sources, places, own = at[rows], had[rows], bits[rows]
        for bit in range(64):
            has = (own >> np.uint64(bit)) & np.uint64(1) == 1
            walked, old = sources[has & (sources >= 0)], places[has & (places >= 0)]
            if not len(walked):
                continue
            old = old[old < words * 64]
            met = np.zeros(words, np.uint64)
            for k in walked[heavy[walked]]:
                met |= spread[k]
            light = [spread[k] for k in walked[~heavy[walked]]]
            some = np.unique(np.concatenate(light)) if light else np.zeros(0, np.int64)
            in_met = lambda x: (met[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1) == 1
            some = some[~in_met(some)]
            n = int(np.bitwise_count(met).sum()) + len(some) - int(in_met(old).sum()) - int(np.isin(old, some).sum())
            if n:
                out.append((int(parts[rows[0]]), bit, n))
    return pa.table({"part": pa.array([r[0] for r in out], pa.int64()), "bit": pa.array([r[1] for r in out], pa.int32()), "n": pa.array([r[2] for r in out], pa.int64())})


def reach_totals(roots: DataFrame, edges: DataFrame, hops: int, bucket_arcs: int = BUCKET_ARCS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`reach_counts` of `reach_bits`, without rows for what the last step reaches, which can be all nodes from each root.

    Ends of arcs are numbered within buckets, roots dealt to blocks; for each block and bucket one task counts. Arcs move once
    per block, reached nodes once per bucket. An edge that lacks an end leads nowhere.
    """
    edges = edges.where("source is not null and target is not null")
    if hops < 1:
        return reach_counts(roots, reach_bits(roots, edges, hops))
    reached = checkpointed(reach_bits(roots, edges, hops - 1))
    ends = F.array(F.struct("source", "target"), F.struct(F.col("target").alias("source"), F.col("source").alias("target")))
    frontier = reached.where(F.col("hop") == hops - 1).select(F.col("node").alias("source")).distinct()
    arcs = checkpointed(edges.select(F.inline(ends)).distinct().join(frontier, "source", "left_semi"))
    buckets, blocks = arcs.count() // bucket_arcs + 1, max(reached.count() // block_rows + 1, 2 * edges.sparkSession.sparkContext.defaultParallelism)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("target")) - 1
    numbered = arcs.select("target").distinct().withColumn("bucket", F.pmod(F.xxhash64("target"), F.lit(buckets))).withColumn("place", place.cast("long"))
    numbered = checkpointed(numbered)
    lists = checkpointed(arcs.join(numbered, "target").groupBy("bucket", "source").agg(F.collect_list("place").alias("places")))
    each = lambda n, kind: F.explode(F.sequence(F.lit(0).cast(kind), F.lit(n - 1).cast(kind)))
    block = F.pmod(F.col("part"), F.lit(blocks)).cast("int").alias("block")
    none = lambda kind: F.lit(None).cast(kind)
    last = reached.where(F.col("hop") == hops - 1).select(block, each(buckets, "long").alias("bucket"), "part", "bits", F.col("node").alias("source"), none("long").alias("place"))
    had = reached.join(numbered, F.col("node") == F.col("target")).select(block, "bucket", "part", "bits", none("string").alias("source"), "place")
    posted = lists.select(each(blocks, "int").alias("block"), "bucket", "source", "places")
    tasks = ("block", "bucket")
    counted = posted.groupBy(*tasks).cogroup(last.unionByName(had).groupBy(*tasks)).applyInArrow(_last_hop, LAST)
    fresh = counted.groupBy("part", "bit").agg(F.sum("n").alias("n")).join(roots, ["part", "bit"])
    return reach_counts(roots, reached).unionByName(fresh.select("root", F.lit(hops).alias("hop"), "n"))


def reach(seeds: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """(root, node, hop): every node within `hops` undirected steps of a seed, at its least distance."""
    roots = checkpointed(numbered_roots(seeds))
    bits = F.expr("filter(sequence(0, 63), k -> (shiftrightunsigned(bits, k) & 1L) = 1L)")
    rows = reach_bits(roots, edges, hops).select("node", "part", "hop", F.explode(bits).alias("bit"))
    return rows.join(roots, ["part", "bit"]).select("root", "node", "hop")


def taxonomy(levels: list[tuple[str, DataFrame]], links: list[tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a typed graph: levels are (kind, frame of id and label), links (relation, frame of source and target)."""
    nodes = None
    for kind, frame in levels:
        part = frame.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label"))
        nodes = part if nodes is None else nodes.unionByName(part)
    edges = None
    for relation, frame in links:
        part = frame.select(F.lit(relation).alias("relation"), F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target"))
        edges = part if edges is None else edges.unionByName(part)
    return nodes.dropDuplicates(["kind", "id"]), edges.distinct()
