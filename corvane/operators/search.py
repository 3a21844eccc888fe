"""Text search: substring and token filters, BM25 with abstention, re-ranking, retrieval status."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import checkpointed

# The ranking function's constants.
K1, B = 1.2, 0.75
CUT_OFF, MIN_TERMS, MIN_IDF = -5.0, 2, 1e-6


def haystack(*columns: str) -> Column:
    """All columns as one lower-cased text; a null keeps its separators."""
    return F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))


def substring_search(frame: DataFrame, text: str, columns: tuple[str, ...], order: str, limit: int = -1) -> DataFrame:
    """Rows that hold the whole text somewhere, ignoring case; a negative limit means all."""
    found = frame.where(haystack(*columns).contains(text.strip().lower())).orderBy(order)
    return found if limit < 0 else found.limit(limit)


def token_search(frame: DataFrame, text: str, columns: tuple[str, ...], order: str, most: int = 200) -> DataFrame:
    """Rows that hold every blank-separated token, the first `most` of them."""
    tests = [haystack(*columns).contains(token) for token in text.lower().split()]
    return frame.where(reduce(Column.__and__, tests, F.lit(True))).orderBy(order).limit(most)


def word_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def phrases(query: str, most: int = 32) -> list[list[str]]:
    """The query's distinct terms, first seen first, each as its tokens (`a_b` is a phrase of two)."""
    terms = list(dict.fromkeys(re.findall(r"\w+", query.casefold())))[:most]
    return [tokens for term in terms if (tokens := re.findall(r"[^\W_]+", term))]


def spaced(text: Column) -> Column:
    """The tokens of a text in lower case, each between two blanks of its own; ' ' for none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", "  ")), F.lit(" "))


def phrase_count(tokens: Column, phrase: list[str]) -> Column:
    """How often the tokens of a phrase follow each other in a `spaced` text, not overlapping."""
    wanted = " " + "  ".join(phrase) + " "
    return ((F.length(tokens) - F.length(F.replace(tokens, F.lit(wanted), F.lit("")))) / len(wanted)).cast("int")


def bm25(
    frame: DataFrame,
    query: str,
    key: str,
    text: str,
    limit: int = 10,
    cut_off: float = CUT_OFF,
    min_terms: int = MIN_TERMS,
) -> DataFrame:
    """(key, score, terms), best (lowest) score first, or nothing.

    A row is kept if at least `min_terms` distinct query terms match it or its score reaches the
    cut-off; weak rows go before the limit applies, so they cannot crowd others out.

    Only the query's own terms are counted, in one pass over the text that leaves a few numbers
    per row; the corpus statistics are one row of sums of these. Nothing but that row moves.
    """
    terms = phrases(query)
    if not terms:
        return frame.select(key, F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("terms")).limit(0)
    tokens = F.length("_t") - F.length(F.replace(F.col("_t"), F.lit("  "), F.lit(" "))) + 1
    # the generator keeps the optimiser from copying the tokenised text into each count
    counted = frame.select(F.col(key), F.explode(F.array(spaced(F.col(text)))).alias("_t")).select(
        key, F.when(F.length("_t") > 2, tokens).otherwise(0).alias("_d"), *(phrase_count(F.col("_t"), p).alias(f"_f{k}") for k, p in enumerate(terms))
    )
    counted = checkpointed(counted)  # a few numbers per row, used twice
    total = counted.agg(
        F.count("*").alias("_n"), F.avg("_d").alias("_avg"), *(F.count_if(F.col(f"_f{k}") > 0).alias(f"_n{k}") for k in range(len(terms)))
    )
    joined = counted.where(reduce(Column.__or__, (F.col(f"_f{k}") > 0 for k in range(len(terms))))).crossJoin(F.broadcast(total))  # one row

    def part(k: int) -> Column:
        n, f = F.col(f"_n{k}"), F.col(f"_f{k}")
        idf = F.ln((F.col("_n") - n + 0.5) / (n + 0.5))
        weight = F.when(idf > 0, idf).otherwise(MIN_IDF)
        return weight * f * (K1 + 1) / (f + K1 * ((1 - B) + B * F.col("_d") / F.col("_avg")))

    scored = joined.select(
        key,
        (-reduce(add, (part(k) for k in range(len(terms))))).alias("score"),
        reduce(add, (F.when(F.col(f"_f{k}") > 0, 1).otherwise(0) for k in range(len(terms)))).cast("long").alias("terms"),
    )
    return scored.where((F.col("terms") >= min_terms) | (F.col("score") <= cut_off)).orderBy("score", key).limit(limit)


def with_status(found: DataFrame) -> DataFrame:
    """One row: EVIDENCE_FOUND or ABSTAIN_NO_MATCH, and how many rows were found."""
    n = F.count("*")
    return found.agg(F.when(n > 0, "EVIDENCE_FOUND").otherwise("ABSTAIN_NO_MATCH").alias("status"), n.alias("n_found"))


def with_payload(found: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """Found rows with what belongs to them: for each of the parts (rows with record_id, e.g. claims, evidence, edges) an array of
    structs, sorted, empty where there is none. Parts are cut to the found records before they are gathered."""
    out = found
    for name, rows in parts.items():
        fields = [c for c in rows.columns if c != "record_id"]
        own = rows.join(found.select(F.col(key).alias("record_id")), "record_id", "left_semi")
        gathered = own.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name)).withColumnRenamed("record_id", "_record")
        out = out.join(gathered, F.col(key) == F.col("_record"), "left").drop("_record").withColumn(name, F.coalesce(name, F.array().cast(gathered.schema[name].dataType)))
    return out


def rerank(found: DataFrame, symbols: list[str], paths: list[str], symbol_tokens: str, path_tokens: str, key: str, keep: int = 5) -> DataFrame:
    """Re-orders a first result by 4 points for each shared symbol and 2 for each shared path token."""

    def shared(column: str, wanted: list[str]) -> Column:
        return F.size(F.array_intersect(F.col(column), F.array(*(F.lit(w) for w in wanted)).cast("array<string>")))

    weight = 4 * shared(symbol_tokens, symbols) + 2 * shared(path_tokens, paths)
    return found.withColumn("weight", weight.cast("long")).orderBy(F.col("weight").desc(), "score", key).limit(keep)
