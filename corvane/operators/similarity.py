"""Sparse TF-IDF neighbours, dense nearest neighbours and MinHash LSH candidates."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.compiled import can_compile, text_signature
from corvane.functions.scores import rounded, scaled
from corvane.functions.vectors import EMPTY_HASH, PERMUTATIONS, band_keys, estimated_jaccard, hash_words
from corvane.operators.search import word_tokens
from corvane.session import checkpointed


def inverse_frequencies(features: DataFrame, total: DataFrame | None = None) -> DataFrame:
    """(feature, df, n, idf) of a long table (key, feature) of distinct pairs: idf = ln(n / df); with a weight, also heavy,
    the largest product of both.

    total: one row with the number of keys as n; counted from the pairs if not given. Counts are combined
    before the one shuffle, of one row per task and feature.
    """
    if total is None:
        total = features.agg(F.countDistinct("key").alias("n"))
    counts = [F.count("*").alias("df"), *([F.max("weight").alias("most")] if "weight" in features.columns else [])]
    found = features.groupBy("feature").agg(*counts).crossJoin(F.broadcast(total))  # one row
    found = found.withColumn("idf", F.ln(F.col("n") / F.col("df")))
    return found.withColumn("heavy", F.col("most") * F.col("idf")).drop("most") if "weight" in features.columns else found


def weighted(features: DataFrame, frequencies: DataFrame) -> DataFrame:
    """(key, feature, w, length, df, n, heavy): tf-idf weights above 0, rounded to 4 places, and the key's length.

    The length comes from the unrounded weights; a cosine is the product of the rounded weights over both lengths.
    """
    raw = features.join(frequencies, "feature").withColumn("w", F.col("weight") * F.col("idf")).where("w > 0")
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("key")))
    return raw.withColumn("length", length).select("key", "feature", rounded(F.col("w")).alias("w"), "length", "df", "n", "heavy")


#: A query is scored against that many keys of each of its HEAVIEST features first, for a floor of its k-th best score.
PROBES, HEAVIEST = 32, 8


def signs(vectors: DataFrame) -> DataFrame:
    """(key, sign): the same sign for just the keys of equal vectors."""
    whole = vectors.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("feature", "w"))).alias("v"), F.max("length").alias("length"))
    return whole.select("key", F.unhex(F.sha2(F.to_json(F.struct("v", "length")), 256)).alias("sign"))


def suffixes(vectors: DataFrame) -> DataFrame:
    """Adds `rest`, the norm of a key's weights behind this feature in one order of all features, heavy ones first, and `upto`, with this one."""
    later = Window.partitionBy("key").orderBy("heavy", F.col("feature").desc()).rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.col("w") * F.col("w")).over(later), F.lit(0.0))
    return vectors.withColumn("rest", F.sqrt(squares)).withColumn("upto", F.sqrt(squares + F.col("w") * F.col("w")))


def _scores(pairs: DataFrame, asked: DataFrame, vectors: DataFrame) -> DataFrame:
    """(key, other, score) of pairs from their whole vectors, above 0."""
    left = pairs.join(asked.select("key", "feature", F.col("w").alias("a"), F.col("length").alias("la")), "key")
    right = vectors.select(F.col("key").alias("other"), "feature", F.col("w").alias("b"), F.col("length").alias("lb"))
    return (
        left.join(right, ["other", "feature"])
        .groupBy("key", "other")
        .agg(F.sum(F.col("a") * F.col("b")).alias("dot"), F.first("la").alias("la"), F.first("lb").alias("lb"))
        .where("dot > 0")
        .select("key", "other", scaled(F.col("dot") / (F.col("la") * F.col("lb"))).alias("score"))
    )


def candidates(vectors: DataFrame, asked: DataFrame, selective: Column, k: int) -> DataFrame:
    """(key, other): pairs of `asked` with `vectors` that may be among the k best, no key with itself.

    Features stand in one order for all keys, heavy ones first. If a pair's first common feature is f, its product is at most
    w_f * w_f' + rest * rest' by what both have behind f. A floor of each key's k-th best score, from exact scores with a few
    keys of its heaviest features, drops first the features from which on a key can't reach it with anything, which are then
    not looked up, then the pairs whose bound stays below it. Equal scores stay, as ties go by key.
    """
    own, others = suffixes(asked), suffixes(vectors)
    finders = own.where(selective)
    posted = others.where(selective).select(F.col("key").alias("other"), "feature", F.col("w").alias("b"), F.col("rest").alias("behind"), F.col("length").alias("lb"))
    heaviest = finders.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy(F.col("heavy").desc(), "feature"))).where(F.col("nth") <= HEAVIEST)
    few = posted.withColumn("nth", F.row_number().over(Window.partitionBy("feature").orderBy("other"))).where(F.col("nth") <= PROBES)
    probes = heaviest.select("key", "feature").join(few.select("feature", "other"), "feature").where("key <> other").select("key", "other").distinct()
    placed = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc()))
    floors = _scores(probes, asked, vectors).withColumn("nth", placed).where(F.col("nth") == k).select("key", F.col("score").alias("floor"))
    longest = others.groupBy("key").agg((F.max("upto") / F.max("length")).alias("r")).agg(F.max("r").alias("r"))  # rounding can lengthen a vector
    may = F.col("floor").isNull()
    within = lambda bound: may | (scaled(bound * (1 + 1e-9)) >= F.col("floor"))
    looked = finders.join(floors, "key", "left").crossJoin(F.broadcast(longest))  # one row
    looked = looked.where(within(F.col("upto") / F.col("length") * F.col("r"))).select("key", "feature", "w", "rest", "length", "floor")
    met = looked.join(posted, "feature").where("key <> other")
    bound = (F.col("w") * F.col("b") + F.col("rest") * F.col("behind")) / (F.col("length") * F.col("lb"))
    return met.where(within(bound)).select("key", "other").distinct()


def related(features: DataFrame, is_query: Column, k: int = 10, cut: float = 0.05, min_keys: int = 40) -> DataFrame:
    """(key, other, score, rank): the k most similar keys of each query key.

    features: (key, feature, weight), one row per pair of key and feature. A feature that more
    than `cut` of at least `min_keys` keys have finds no candidates, which keeps the join on
    features free of hot keys, but it counts in the score. Ties go to the smaller key.

    Keys of equal vectors are compared once, as a class: of a class only its k + 1 smallest keys can be among the k best of
    any key. `candidates` bounds pairs of classes before whole vectors meet.
    """
    everything = checkpointed(weighted(features, inverse_frequencies(features)))
    signed = checkpointed(signs(everything))
    least = signed.groupBy("sign").agg(F.min("key").alias("class"))
    place = F.row_number().over(Window.partitionBy("sign").orderBy("key"))
    members = signed.withColumn("place", place).where(F.col("place") <= k + 1).join(least, "sign").select("key", "class")
    selective = (F.col("n") < min_keys) | (F.col("df") <= cut * F.col("n"))
    queries = checkpointed(signed.where(is_query).join(least, "sign").select("key", "class"))
    vectors = checkpointed(everything.join(least.select(F.col("class").alias("key")), "key", "left_semi"))
    asked = checkpointed(vectors.join(queries.select(F.col("class").alias("key")).distinct(), "key", "left_semi"))
    pairs = candidates(vectors, asked, selective, k)
    found = _scores(pairs, asked, vectors)
    best = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "other"))
    found = found.withColumn("nth", best).where(F.col("nth") <= k).drop("nth")
    itself = asked.where(selective).select("key").distinct()
    own = _scores(itself.select("key", F.col("key").alias("other")), asked, vectors)
    of_class = found.unionByName(own).select(F.col("key").alias("class"), F.col("other").alias("at"), "score")
    spread = queries.join(of_class, "class").join(members.select(F.col("key").alias("other"), F.col("class").alias("at")), "at").where("key <> other")
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "other"))
    return spread.select("key", "other", "score").withColumn("rank", rank).where(F.col("rank") <= k)


#: Weight of a feature by its prefix.
FEATURE_WEIGHTS = {"cwe": 3.0, "fam": 2.0, "proj": 1.0, "sub": 2.0, "path": 1.0, "fn": 3.0, "fixcall": 2.0, "kg": 1.0}
#: Path tokens that say nothing.
EXTENSIONS = ("c", "h", "cc", "cpp", "cxx", "py", "sh", "rs", "go", "java", "js", "ts")
#: Families of CWE numbers; any other stated CWE is of family `other`.
CWE_FAMILIES = {
    "memory-safety": (119, 120, 121, 122, 125, 126, 127, 131, 190, 191, 193, 415, 416, 476, 680, 681, 786, 787, 788, 805, 822, 823, 824, 825, 908, 909),
    "resource-management": (400, 401, 404, 674, 770, 772, 789, 834, 835),
    "concurrency": (362, 366, 367, 413, 667),
    "injection": (74, 77, 78, 79, 88, 89, 91, 93, 94, 113),
    "input-validation-and-paths": (20, 22, 23, 59, 61, 73, 129, 436, 444, 1284),
    "access-control-and-crypto": (250, 269, 276, 284, 285, 287, 290, 294, 295, 297, 306, 310, 311, 312, 319, 326, 327, 328, 330, 338, 345, 347, 352, 354, 384, 522, 639, 732, 862, 863),
    "information-exposure": (200, 201, 203, 208, 209, 532),
    "logic-and-numeric-errors": (369, 617, 670, 682, 697, 704, 754, 755, 843, 1335),
}


def record_features(records: DataFrame) -> DataFrame:
    """(key, feature, weight): what `related` compares records by, each feature of a record once.

    records: key, cwe, project, subsystem, files (array of struct with path and functions, an array
    of names) and changes (array of struct with name, calls and grams, arrays of what the fix added
    or removed). A record without a subsystem takes the top folder of its first path with a folder.
    """
    none = F.array().cast("array<string>")

    def kind(prefix: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.concat(F.lit(prefix + ":"), v))

    def single(value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.array(value)).otherwise(none)

    def nested(column: str, field: str) -> Column:
        lists = F.transform(F.coalesce(F.col(column), F.array()), lambda x: F.coalesce(x[field], none))
        return F.transform(F.flatten(lists), lambda v: F.lower(v))

    stated = F.when(F.col("cwe") != "UNKNOWN", F.col("cwe"))
    number = F.regexp_extract("cwe", r"^\s*(?:CWE-)?\s*([0-9]+)\s*$", 1).try_cast("int")
    family = F.lit("other")
    for name, numbers in CWE_FAMILIES.items():
        family = F.when(number.isin(*numbers), name).otherwise(family)
    paths = F.filter(F.transform(F.coalesce(F.col("files"), F.array()), lambda f: f["path"]), lambda p: p.isNotNull())
    top = F.lower(F.substring_index(F.get(F.filter(paths, lambda p: p.contains("/")), 0), "/", 1))
    own = F.coalesce(F.col("subsystem"), F.lit("")) != ""
    subsystem = F.when(own, F.array(F.lower("subsystem"))).when(top.isNotNull(), F.array(top)).otherwise(none)
    tokens = F.transform(F.flatten(F.transform(paths, lambda p: F.split(p, "[/._-]+"))), lambda t: F.lower(t))
    names = F.transform(F.coalesce(F.col("changes"), F.array()), lambda c: F.lower(c["name"]))
    filled = lambda values: F.filter(values, lambda v: v != "")
    features = F.concat(
        kind("cwe", single(stated)),
        kind("fam", F.when(F.coalesce(stated, F.lit("")) != "", F.array(family)).otherwise(none)),
        kind("proj", single(F.lower("project"))),
        kind("sub", subsystem),
        kind("path", F.filter(tokens, lambda t: (F.length(t) >= 2) & ~t.isin(*EXTENSIONS))),
        kind("fn", filled(F.concat(nested("files", "functions"), names))),
        kind("fixcall", nested("changes", "calls")),
        kind("kg", nested("changes", "grams")),
    )
    rows = records.select("key", F.explode(F.array_distinct(features)).alias("feature"))
    weights = F.create_map(*(F.lit(x) for item in FEATURE_WEIGHTS.items() for x in item))
    return rows.withColumn("weight", weights[F.substring_index("feature", ":", 1)])


def explain_pairs(vectors: DataFrame, pairs: DataFrame, k: int = 3) -> DataFrame:
    """(key, other, reasons): the k features that give a pair most of its score."""
    both = pairs.join(vectors.select("key", "feature", F.col("w").alias("a")), "key").join(
        vectors.select(F.col("key").alias("other"), "feature", F.col("w").alias("b")), ["other", "feature"]
    )
    rank = F.row_number().over(Window.partitionBy("key", "other").orderBy((F.col("a") * F.col("b")).desc(), "feature"))
    top = both.withColumn("rank", rank).where(F.col("rank") <= k)
    reasons = F.transform(F.array_sort(F.collect_list(F.struct("rank", "feature"))), lambda x: x["feature"])
    return top.groupBy("key", "other").agg(reasons.alias("reasons"))


#: Query vectors that are sent to all executors for one scan, and those that a worker multiplies at once.
QUERY_BLOCK, AT_ONCE = 16_384, 1024


def _nearest(ids: list[int], matrix: np.ndarray, k: int):
    """Best k rows of each batch for each query; batches merge within the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int]]] = [[] for _ in ids]  # heaps of (score, -id)
        for batch in batches:
            keys = batch.column("id").to_pylist()
            rows = [np.asarray(v, np.float64) for v in batch.column("vector").to_pylist()]
            if not rows:
                continue
            block = np.stack(rows)
            lengths = np.linalg.norm(block, axis=1)
            block = (block / np.where(lengths > 0, lengths, 1.0)[:, None]).T
            for first in range(0, len(ids), AT_ONCE):
                for q, row in enumerate(matrix[first : first + AT_ONCE] @ block, first):
                    enough = min(len(row), k + 1)
                    for at in np.argpartition(-row, enough - 1)[:enough] if len(row) > enough else range(len(row)):
                        if keys[at] != ids[q]:
                            entry = (float(row[at]), -keys[at])
                            heap = best[q]
                            if len(heap) < k:
                                heapq.heappush(heap, entry)
                            elif entry > heap[0]:
                                heapq.heapreplace(heap, entry)
        rows = [(ids[q], -key, score) for q, heap in enumerate(best) for score, key in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["query", "id", "score"])

    return run


def nearest(queries: DataFrame, frame: DataFrame, k: int = 10, block: int = QUERY_BLOCK) -> DataFrame:
    """(query, id, score, rank): the k rows of highest cosine for each query, itself left out.

    Both frames have (id, vector). Queries go in blocks of bounded size; each task keeps k
    candidates per query, so what is shuffled grows with the tasks, not with the rows.
    """
    wanted = queries.select("id", "vector").where("vector is not null").orderBy("id")
    out = None
    last = None
    while True:
        part = (wanted if last is None else wanted.where(F.col("id") > last)).limit(block).collect()  # block rows
        if not part and out is not None:
            break
        matrix = np.array([r["vector"] for r in part], np.float64).reshape(len(part), -1)
        lengths = np.linalg.norm(matrix, axis=1) if len(part) else np.zeros(0)
        matrix = matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
        found = frame.where("vector is not null").select("id", "vector").mapInArrow(_nearest([r["id"] for r in part], matrix, k), "query long, id long, score double")
        out = found if out is None else out.unionByName(found)
        if len(part) < block:
            break
        last = part[-1]["id"]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def lsh_classes(left: DataFrame, right: DataFrame, threshold: float = 0.3, permutations: int = 64) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(left members, right members, pairs of their classes) that share a band of their signatures and are similar enough.

    Both frames have (id, signature). Rows of one signature are a class, named by its least id; members are
    (class_id, id), pairs (left_class, right_class, jaccard). Rows whose signature has the wrong length, or none,
    cannot be filtered: on each side they are one class (class_id ''), which is paired with every class of the other
    side, jaccard null. So a group of copies, or of unusable rows, costs one row on either side, whatever its size.
    """
    usable = F.coalesce(F.size("signature") == permutations, F.lit(False))
    def classes(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = frame.select("id", F.when(usable, F.col("signature")).alias("signature"))
        each = marked.groupBy("signature").agg(F.min("id").alias("first"))
        each = checkpointed(each.select("signature", F.when(F.col("signature").isNotNull(), F.col("first").cast("string")).otherwise("").alias("class_id")))
        members = marked.join(each, marked["signature"].eqNullSafe(each["signature"])).select("class_id", "id")
        return each, members

    def banded(frame: DataFrame, side: str) -> DataFrame:
        return frame.where("signature is not null").select(F.col("class_id").alias(f"{side}_class"), F.posexplode(band_keys(F.col("signature"))).alias("band", "part"))

    (a, members_a), (b, members_b) = classes(left), classes(right)
    near = banded(a, "left").join(banded(b, "right"), ["band", "part"]).select("left_class", "right_class").distinct()
    judged = (
        near.join(a.select(F.col("class_id").alias("left_class"), F.col("signature").alias("l")), "left_class")
        .join(b.select(F.col("class_id").alias("right_class"), F.col("signature").alias("r")), "right_class")
        .select("left_class", "right_class", estimated_jaccard(F.col("l"), F.col("r")).alias("jaccard"))
        .where(F.col("jaccard") >= threshold)
    )
    # the unusable class of a side is one row at most: a broadcast of it against the classes of the other
    odd_a, odd_b = a.where("class_id = ''").select(F.col("class_id").alias("left_class")), b.where("class_id = ''").select(F.col("class_id").alias("right_class"))
    loose = (
        b.select(F.col("class_id").alias("right_class")).join(F.broadcast(odd_a)).select("left_class", "right_class")
        .unionByName(a.where("class_id <> ''").select(F.col("class_id").alias("left_class")).join(F.broadcast(odd_b)).select("left_class", "right_class"))
    )
    return members_a, members_b, judged.unionByName(loose.withColumn("jaccard", F.lit(None).cast("double")))


#: Keys of one block, whose equal ones are hashed once: some 60 MB in a worker.
BLOCK_KEYS = 2_000_000


def _gram_keys(joined: str, k: int) -> np.ndarray:
    """The keys of `vectors.k_grams` as numbers, each once."""
    tokens = joined.split("\x1f") if joined else []
    starts = range(max(len(tokens) - k + 1, 1)) if tokens else ()
    found = {hashlib.sha256("\x1f".join(tokens[i : i + k]).encode()).digest()[:4] for i in starts}
    return np.frombuffer(b"".join(found), ">u4").astype(np.uint32)


def _least_hashes(keys: list[np.ndarray], permutations: int) -> np.ndarray:
    """A row per array of keys: the least hash of each permutation. Keys that several arrays have are hashed once."""
    sizes = np.array([len(x) for x in keys], np.int64)
    out = np.full((len(keys), permutations), EMPTY_HASH, np.int64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.cumsum(sizes[some]) - sizes[some]
        distinct, places = np.unique(np.concatenate(keys), return_inverse=True)
        for i, hashes in enumerate(hash_words(distinct, [b"%d:" % i for i in range(permutations)])):
            out[some, i] = np.minimum.reduceat(hashes[places], starts)
    return out


def _signatures(k: int, permutations: int, most: int = BLOCK_KEYS):
    """`vectors.k_grams` and `vectors.minhash` of the tokens of each row, in time linear in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, keys = 0, 0, []
            for at, joined in enumerate(batch.column("tokens"), 1):
                keys.append(_gram_keys(joined.as_py(), k))
                held += len(keys[-1])
                if held >= most or at == batch.num_rows:
                    signatures = pa.FixedSizeListArray.from_arrays(pa.array(_least_hashes(keys, permutations).ravel()), permutations).cast(pa.list_(pa.int64()))
                    sizes = pa.array([len(x) for x in keys], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, at - first), sizes, signatures], names=["id", "n_grams", "signature"])
                    first, held, keys = at, 0, []

    return run


def text_signatures(frame: DataFrame, id: str, text: str, k: int = 3, permutations: int = PERMUTATIONS) -> DataFrame:
    """(id, n_grams, signature): MinHash of the distinct word k-grams of every row's text.

    Keys and hashes are those of `vectors.k_grams` and `vectors.minhash`; a text without a word has
    no grams and a signature of all ones. Texts are dealt out to more tasks than there are cores. Where Spark's compiler can't be
    reached, Python's workers hash, which takes several times as long.
    """
    spark = frame.sparkSession
    # a file that can't be split is one task of minutes, as a MB of texts takes seconds
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt = frame.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).repartition(tasks, "id")
    words = dealt.select("id", F.array_join(word_tokens(F.col("text")), "\x1f").alias("tokens"))
    if not can_compile(spark):
        return words.mapInArrow(_signatures(k, permutations), "id long, n_grams long, signature array<long>")
    found = words.select("id", text_signature(spark, F.col("tokens"), k, permutations).alias("found"))
    return found.select("id", F.element_at("found", 1).alias("n_grams"), F.slice("found", 2, permutations).alias("signature"))


def signature_classes(prints: DataFrame) -> DataFrame:
    """(class_id, signature, n_rows): equal signatures are one class, named after its least id."""
    return prints.groupBy("signature").agg(F.min("id").alias("class_id"), F.count("*").alias("n_rows")).where("class_id is not null")


def class_members(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """prints with the class_id of each row."""
    return prints.join(classes.select("signature", "class_id"), "signature")


def near_classes(classes: DataFrame) -> DataFrame:
    """(left, right, jaccard): all pairs of different classes that share a band, each once, left < right.

    Members are not expanded: a group of copies costs one row here, whatever its size.
    """
    bands = classes.select("class_id", F.posexplode(band_keys(F.col("signature"))).alias("band", "part"))
    other = bands.withColumnRenamed("class_id", "right")
    near = bands.withColumnRenamed("class_id", "left").join(other, ["band", "part"]).where("left < right").select("left", "right").distinct()
    left = classes.select(F.col("class_id").alias("left"), F.col("signature").alias("l"))
    right = classes.select(F.col("class_id").alias("right"), F.col("signature").alias("r"))
    return near.join(left, "left").join(right, "right").select("left", "right", estimated_jaccard(F.col("l"), F.col("r")).alias("jaccard"))


def near_duplicate_pairs(prints: DataFrame, classes: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(left, right, jaccard): similar enough classes, and each further row of a class with its class (1.0).

    Linear in the size of a group of copies: two members of a class, or of two similar classes, are
    a pair through their class_ids.
    """
    copies = class_members(prints, classes).where("id > class_id").select(F.col("class_id").alias("left"), F.col("id").alias("right"), F.lit(1.0).alias("jaccard"))
    return near_classes(classes).where(F.col("jaccard") >= threshold).unionByName(copies)
