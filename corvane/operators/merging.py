"""Merging overlapping catalogs: precedence, overlays, provenance, aliases, ordered unions."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import commit_of_url


def ordered_union(value: Column, order: Column) -> Column:
    """Aggregate: the elements of all arrays, first seen first, once each."""
    arrays = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.coalesce(value, F.array().cast("array<string>")).alias("v"))))
    return F.array_distinct(F.flatten(F.transform(arrays, lambda x: x["v"])))


def by_precedence(value: Column, authoritative: Column, order: Column) -> Column:
    """Aggregate: the last non-null authoritative value, else the first non-null one. '' is a value."""
    last = F.max_by(value, F.when(authoritative & value.isNotNull(), order))
    first = F.min_by(value, F.when(value.isNotNull(), order))
    return F.coalesce(F.when(F.count_if(authoritative & value.isNotNull()) > 0, last), first)


def merge_catalogs(rows: DataFrame, keys: list[str], values: list[str], arrays: list[str], order: str = "ord", authoritative: str = "auth") -> DataFrame:
    """One row per key: `values` by precedence, `arrays` as ordered unions.

    One shuffle on the key; all columns fold in the same aggregation.
    """
    return rows.groupBy(*keys).agg(
        *(by_precedence(F.col(c), F.col(authoritative), F.col(order)).alias(c) for c in values),
        *(ordered_union(F.col(c), F.col(order)).alias(c) for c in arrays),
    )


def overlay(frame: DataFrame, extra: DataFrame, key: str, column: str, source: str, own: str = "catalog") -> DataFrame:
    """Fills nulls of `column` from `extra` (key, column, source) and tells where each value is from."""
    other = extra.select(F.col(key), F.col(column).alias("_value"), F.col(source).alias("_source"))
    return (
        frame.join(other, key, "left")
        .withColumn(source, F.when(F.col(column).isNotNull(), own).when(F.col("_value").isNotNull(), F.col("_source")))
        .withColumn(column, F.coalesce(column, "_value"))
        .drop("_value", "_source")
    )


def first_source(*candidates: tuple[str, Column]) -> tuple[Column, Column]:
    """(value, name) of the first candidate that is not null."""
    value = F.coalesce(*(c for _, c in candidates))
    name = reduce(lambda rest, kv: F.when(kv[1].isNotNull(), kv[0]).otherwise(rest), reversed(candidates), F.lit(None).cast("string"))
    return value, name


def append_missing(frame: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """frame plus the rows of extra whose key it lacks, the first of each key by `ord`."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("ord"))
    fresh = extra.join(frame.select(*keys).distinct(), keys, "left_anti").withColumn("_n", first).where("_n = 1").drop("_n", "ord")
    return frame.unionByName(fresh, allowMissingColumns=True)


def fold_twins(rows: DataFrame, prefix: str, key: str = "advisory_id", aliases: str = "aliases", arrays: tuple[str, ...] = ("fix_shas",)) -> DataFrame:
    """A row with an alias of the preferred prefix goes into that alias's row, if there is one.

    Its id becomes an alias and its arrays are appended.
    """
    preferred = rows.where(F.col(key).startswith(prefix))
    twins = rows.where(~F.col(key).startswith(prefix)).select(
        F.col(key).alias("_twin"), F.explode(F.filter(F.coalesce(aliases, F.array().cast("array<string>")), lambda a: a.startswith(prefix))).alias(key), *(F.col(c).alias(f"_{c}") for c in arrays)
    )
    pairs = twins.join(preferred.select(key), key)
    grouped = pairs.groupBy(key).agg(
        F.array_sort(F.collect_set("_twin")).alias("_twins"),
        *(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_twin", F.col(f"_{c}").alias("v")))), lambda x: x["v"])).alias(f"_{c}") for c in arrays),
    )
    empty = F.array().cast("array<string>")
    merged = preferred.join(grouped, key, "left").withColumns(
        {aliases: F.array_union(F.coalesce(aliases, empty), F.coalesce("_twins", empty))}
        | {c: F.array_union(F.coalesce(c, empty), F.coalesce(f"_{c}", empty)) for c in arrays}
    )
    rest = rows.where(~F.col(key).startswith(prefix)).join(pairs.select(F.col("_twin").alias(key)).distinct(), key, "left_anti")
    return merged.select(rows.columns).unionByName(rest)


def with_aliases(rows: DataFrame, key: str = "advisory_id", aliases: str = "aliases") -> DataFrame:
    """(root, ordinal, id): each advisory itself, then its aliases in their order, one hop."""
    ids = F.concat(F.array(F.col(key)), F.coalesce(aliases, F.array().cast("array<string>")))
    return rows.select(F.col(key).alias("root"), F.posexplode(F.array_distinct(ids)).alias("ordinal", "id"))


def alias_documents(rows: DataFrame, documents: DataFrame, arrays: tuple[str, ...], key: str = "advisory_id") -> DataFrame:
    """(root, found, ...): the documents of an advisory and of its aliases, one hop, as ordered unions of their arrays.

    documents: (id, arrays...); found counts those that exist. The advisory's own come first, then those of its aliases in their order.
    """
    placed = with_aliases(rows, key).join(documents, "id", "left")
    have = F.coalesce(*(F.col(c).cast("string") for c in arrays)).isNotNull()
    return placed.groupBy("root").agg(F.count_if(have).alias("found"), *(ordered_union(F.col(c), F.col("ordinal")).alias(c) for c in arrays))


def with_commits(rows: DataFrame, vetted: DataFrame, key: str = "advisory_id") -> DataFrame:
    """Rows whose fix_shas are their own full hashes, then the vetted ones, then those in their patch URLs, once each.

    vetted: (key, shas), one row per advisory; from_vetted tells whether it had one.
    """
    none = F.array().cast("array<string>")
    own = F.filter(F.transform(F.coalesce("fix_shas", none), F.lower), lambda s: s.rlike("^[0-9a-f]{40}$"))
    linked = F.filter(F.transform(F.coalesce("patch_urls", none), commit_of_url), lambda s: s.isNotNull())
    joined = rows.join(vetted.select(key, F.col("shas").alias("_shas")), key, "left")
    every = F.array_distinct(F.concat(own, F.coalesce("_shas", none), linked))
    return joined.withColumn("fix_shas", every).withColumn("from_vetted", F.col("_shas").isNotNull()).drop("_shas")


def mirror_status(rows: DataFrame, mirror: DataFrame | None, key: str = "advisory_id") -> DataFrame:
    """(key, sha_status, n_missing) of rows with fix_shas: NOT_JOINED without any, MIRROR_UNCHECKED without a mirror,
    NOT_IN_MIRROR if one is missing from the mirror (sha), else VERIFIED_IN_MIRROR."""
    count = F.size(F.coalesce("fix_shas", F.array().cast("array<string>")))
    if mirror is None:
        return rows.select(key, F.when(count == 0, "NOT_JOINED").otherwise("MIRROR_UNCHECKED").alias("sha_status"), F.lit(0).cast("long").alias("n_missing"))
    each = rows.select(key, F.explode_outer("fix_shas").alias("sha")).join(mirror.select("sha", F.lit(True).alias("there")).distinct(), "sha", "left")
    missing = F.count_if(F.col("sha").isNotNull() & F.col("there").isNull())
    status = F.when(F.count("sha") == 0, "NOT_JOINED").when(missing > 0, "NOT_IN_MIRROR").otherwise("VERIFIED_IN_MIRROR")
    return each.groupBy(key).agg(status.alias("sha_status"), missing.alias("n_missing"))


def single_parent_fixes(rows: DataFrame, parents: DataFrame, key: str = "advisory_id") -> DataFrame:
    """rows with fix_shas of one parent only; merges and roots move to the end of fixed_in_shas, and demoted counts them.

    parents: (sha, parents). A fix that it lacks is an error when the result is computed: nothing is guessed.
    """
    none = F.array().cast("array<string>")
    each = rows.select(key, F.posexplode(F.coalesce("fix_shas", none)).alias("at", "sha")).join(parents.dropDuplicates(["sha"]), "sha", "left")
    lacking = F.raise_error(F.concat(F.lit("no parents known of fix "), "sha", F.lit(" of "), F.col(key).cast("string"))).cast("int")
    known = each.withColumn("parents", F.coalesce("parents", lacking))
    in_order = lambda test: F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("at", "sha")))), lambda x: x["sha"])
    split = known.groupBy(key).agg(in_order(F.col("parents") == 1).alias("_kept"), in_order(F.col("parents") != 1).alias("_merges"))
    before = F.coalesce("fixed_in_shas", none) if "fixed_in_shas" in rows.columns else none
    return (
        rows.join(split, key, "left")
        .withColumn("fix_shas", F.coalesce("_kept", none))
        .withColumn("fixed_in_shas", F.array_distinct(F.concat(before, F.coalesce("_merges", none))))
        .withColumn("demoted", F.size(F.coalesce("_merges", none)))
        .drop("_kept", "_merges")
    )


def alias_components(rows: DataFrame, group: list[str], rank: tuple[str, ...] = ("CVE-", "GHSA-"), own: bool = False) -> DataFrame:
    """Joins findings of a group that share ids: primary id, all aliases, fixed versions, first severity.

    The primary id is the first by rank and text of all ids, or with `own` of the findings' own ids; its severity comes
    before those of the others.

    rows: group columns, id, aliases, fixed, severity. The groups, findings of one package in one
    lock file, are small by nature; union-find runs inside each.
    """
    schema = ", ".join(f"{g} string" for g in group) + ", primary string, aliases array<string>, fixed array<string>, severity string"

    def place(identifier: str) -> tuple[int, str]:
        return next((k for k, p in enumerate(rank) if identifier.startswith(p)), len(rank)), identifier

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        root: dict[str, str] = {}

        def find(x: str) -> str:
            root.setdefault(x, x)
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        names = [[i, *(a if a is not None else ())] for i, a in zip(frame["id"], frame["aliases"], strict=True)]
        for ids in names:
            for other in ids[1:]:
                root[find(other)] = find(ids[0])
        parts: dict[str, tuple[set, set, dict, list]] = {}
        turns = sorted(zip(names, frame["fixed"], frame["severity"], strict=True), key=lambda x: place(x[0][0]))
        for ids, versions, severity in turns:
            known, first_ids, fixed, stated = parts.setdefault(find(ids[0]), (set(), set(), {}, []))
            known.update(ids)
            first_ids.add(ids[0])
            fixed.update(dict.fromkeys(versions if versions is not None else ()))
            stated += [severity] if severity else []
        shared, out = [frame[g].iloc[0] for g in group], []
        for known, first_ids, fixed, stated in parts.values():
            first = min(first_ids if own else known, key=place)
            rest = sorted(known - {first}, key=None if own else place)
            out.append((*shared, first, rest, list(fixed), stated[0] if stated else None))
        return pd.DataFrame(out, columns=[*group, "primary", "aliases", "fixed", "severity"])

    return rows.groupBy(*group).applyInPandas(fold, schema)


def fit_record(row: Column, urls: Column, limit: int = 500, most: int = 3) -> Column:
    """The longest prefix of `urls` (of at most `most`) with which row and urls fit `limit` bytes of JSON; null if none does."""
    sizes = F.filter(
        F.transform(F.sequence(F.lit(most), F.lit(0)), lambda n: F.slice(urls, F.lit(1), n)),
        lambda u: F.octet_length(F.to_json(F.struct(row.alias("row"), u.alias("urls")))) <= limit,
    )
    return F.get(sizes, F.lit(0))
