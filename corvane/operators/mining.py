"""Mining source versions: function units, fragments of a fix, fingerprints of a fix, evolution of a fix."""

from __future__ import annotations

import difflib
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.lexing import closing_braces, code_of
from corvane.functions.text import trailers
from corvane.functions.vectors import map_difference
from corvane.operators.comparing import added_guards, full_outer, limit_breadth, unique_pairs
from corvane.operators.intervals import first_unit, in_ranges

#: From good to bad; a whole is as good as its worst part.
COVERAGE_ORDER = ("OK", "PARSER_SKIPPED", "INCOMPLETE")
# Words before a parenthesis that name no function.
KEYWORDS = {"if", "for", "while", "switch", "return", "sizeof", "catch", "do", "else", "case", "defined"}

_HEAD = re.compile(r"(?m)^[A-Za-z_][\w\s\*&:<>,~]*?\b([A-Za-z_]\w*)\s*\(")
UNIT = "path string, symbol string, start int, stop int, body_sha256 string, conditional boolean, coverage string"


def preprocessor_ranges(text: str) -> list[tuple[int, int]]:
    """Line ranges (first to last, 1-based) inside conditional preprocessor blocks, outermost only."""
    out, depth, start = [], 0, 0
    lines = text.splitlines()
    for number, line in enumerate(lines, 1):
        if re.match(r"\s*#\s*if", line):
            depth += 1
            start = number if depth == 1 else start
        elif re.match(r"\s*#\s*endif", line) and depth:
            depth -= 1
            if not depth:
                out.append((start, number))
    return out + ([(start, len(lines))] if depth else [])


def function_units(text: str) -> list[tuple[str, int, int, str, bool, str]]:
    """(symbol, start, stop, body hash, conditional, coverage) of the functions of a C-like text.

    The hash is that of the body, from brace to brace; a function is conditional if its head is. A head
    whose body never closes is reported as PARSER_SKIPPED, without a hash, and the search goes on behind it.
    """
    code = code_of(text, nested=False)
    closing = closing_braces(code)
    inside = preprocessor_ranges(text)
    out, at = [], 0
    while match := _HEAD.search(code, at):
        at = match.end()
        if match[1] in KEYWORDS:
            continue
        body = re.compile(r"[;{]").search(code, match.end())
        if body is None or body[0] == ";":
            continue
        stop = closing.get(body.start())
        first = code.count("\n", 0, match.start(1)) + 1
        last = code.count("\n", 0, len(code) if stop is None else stop) + 1
        conditional = any(a <= first <= b for a, b in inside)
        if stop is None:
            out.append((match[1], first, last, None, conditional, "PARSER_SKIPPED"))
            at = body.end()
            continue
        digest = hashlib.sha256(text[body.start() : stop + 1].encode()).hexdigest()
        out.append((match[1], first, last, digest, conditional, "OK"))
        at = stop + 1
    return out


def units(files: DataFrame) -> DataFrame:
    """Function units of (path, text): a map over files, as braces need a scanner."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(p, *u) for p, text in batch[["path", "text"]].itertuples(index=False) for u in function_units(text or "")]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in UNIT.split(", ")]).astype({"start": "int32", "stop": "int32", "conditional": "bool"})

    return files.select("path", "text").mapInPandas(run, UNIT)


def unified_diffs(pairs: DataFrame) -> DataFrame:
    """(path, patch) of (path, before, after); equal texts give an empty patch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, before, after in batch[["path", "before", "after"]].itertuples(index=False):
                lines = difflib.unified_diff((before or "").splitlines(), (after or "").splitlines(), f"a/{path}", f"b/{path}", lineterm="")
                rows.append((path, "\n".join(lines)))
            yield pd.DataFrame(rows, columns=["path", "patch"])

    return pairs.select("path", "before", "after").mapInPandas(run, "path string, patch string")


def worst(coverage: Column) -> Column:
    """Aggregate: the worst state."""
    rank = F.array_position(F.array(*(F.lit(c) for c in COVERAGE_ORDER)), coverage)
    return F.max_by(coverage, rank)


def changed_units(found: DataFrame, ranges: DataFrame) -> DataFrame:
    """Units (path, start, stop, ...) that overlap a changed range (path, start, stop) of their file.

    The ranges of a file gather into one array, which a patch bounds, and each unit tests them in place.
    """
    per_file = ranges.groupBy("path").agg(F.collect_list(F.struct("start", "stop")).alias("_ranges"))
    return found.join(per_file, "path").where(in_ranges(F.col("start"), F.col("stop"), F.col("_ranges"))).drop("_ranges")


def attribute_lines(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(path, symbol, method, added, removed, conditional, coverage) of diff lines by the unit that holds them.

    lines: (path, kind, old_line, new_line, context); found: units of both sides with `side` old or new. The method is ast for
    lines in a unit; others go to the function that their hunk's header names (hunk_fallback), or to the file (symbol null), with
    coverage INCOMPLETE.
    """
    line = F.when(F.col("kind") == "-", F.col("old_line")).otherwise(F.col("new_line"))
    changed = lines.where(F.col("kind").isin("+", "-")).withColumns({"line": line, "side": F.when(F.col("kind") == "-", "old").otherwise("new")})
    arrays = found.groupBy("path", "side").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "symbol", "conditional", "coverage"))).alias("_units"))
    placed = changed.join(arrays, ["path", "side"], "left").withColumn("_unit", first_unit(F.col("line"), F.col("_units")))
    held = F.col("_unit").isNotNull()
    named = hunk_symbol(F.col("context") if "context" in lines.columns else F.lit(None).cast("string"))
    return placed.groupBy("path", F.when(held, F.col("_unit.symbol")).otherwise(named).alias("symbol"), F.when(held, "ast").otherwise("hunk_fallback").alias("method")).agg(
        F.count_if(F.col("kind") == "+").alias("added"),
        F.count_if(F.col("kind") == "-").alias("removed"),
        F.coalesce(F.bool_or("_unit.conditional"), F.lit(False)).alias("conditional"),
        worst(F.coalesce("_unit.coverage", F.lit("INCOMPLETE"))).alias("coverage"),
    )


def revision_index(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, symbol, state, before, after): units of two revisions that have their path and name once on either side.

    before and after: units as `units` gives them. The state is unchanged or changed by the hash of the body, or skipped where one has none.
    """
    pairs = unique_pairs(before, after, ["path", "symbol"])
    old, new = F.col("before.body_sha256"), F.col("after.body_sha256")
    state = F.when(old.isNull() | new.isNull(), "skipped").when(old == new, "unchanged").otherwise("changed")
    return pairs.select("path", "symbol", state.alias("state"), "before", "after")


def hunk_symbol(context: Column) -> Column:
    """The function that a hunk header's context names: the first `name(` that is no keyword; null for file scope."""
    name = F.regexp_extract(F.coalesce(context, F.lit("")), r"([A-Za-z_][A-Za-z0-9_]*)\s*\(", 1)
    return F.when((name != "") & ~name.isin(*sorted(KEYWORDS)), name)


def fragment_histograms(fragments: DataFrame) -> DataFrame:
    """(kind, value, n): records by coverage, and their functions by coverage and by method, zero rows included.

    fragments: (record_id, coverage, functions), the last an array of structs with coverage and method.
    """
    kinds = [("record_coverage", c) for c in COVERAGE_ORDER] + [("function_coverage", c) for c in COVERAGE_ORDER] + [("method", m) for m in ("ast", "hunk", "hunk_fallback")]
    spark = fragments.sparkSession
    each = fragments.select(F.explode("functions").alias("f"))
    values = F.array(F.struct(F.lit("function_coverage").alias("kind"), F.col("f.coverage").alias("value")), F.struct(F.lit("method").alias("kind"), F.col("f.method").alias("value")))
    counted = fragments.select(F.lit("record_coverage").alias("kind"), F.col("coverage").alias("value")).unionByName(each.select(F.inline(values)))
    counts = counted.groupBy("kind", "value").agg(F.count("*").alias("n"))
    return spark.createDataFrame(kinds, "kind string, value string").join(counts, ["kind", "value"], "full_outer").fillna(0, ["n"])


def fix_fingerprints(before: DataFrame, after: DataFrame, most: int = 60) -> DataFrame:
    """One row per advisory: coverage and files with functions (name, before, after, what was added and removed).

    before and after: (advisory, path, name, ord, grams, calls, guards, coverage), one row per touched function, the
    last two optional; of functions with one name in a file the last counts. k-grams are differences of multisets,
    calls of sets, and guards are those of new kind and variables. The coverage is the worst of the functions'.
    Fixes of too many functions keep none.
    """
    keys = ["advisory", "path", "name"]
    guards, state = "array<struct<kind:string,line:int,vars:array<string>>>", "coverage"

    def filled(frame: DataFrame) -> DataFrame:
        missing = {c: F.lit(None).cast(t) for c, t in (("guards", guards), (state, "string")) if c not in frame.columns}
        return frame.withColumns(missing) if missing else frame

    pairs = full_outer(filled(before), filled(after), keys, "ord")
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    old, new = F.coalesce("before.grams", empty), F.coalesce("after.grams", empty)
    none, no_guard = F.array().cast("array<string>"), F.array().cast(guards)
    both = F.array(F.coalesce("before.coverage", F.lit("OK")), F.coalesce("after.coverage", F.lit("OK")))
    rank = lambda c: F.array_position(F.array(*(F.lit(x) for x in COVERAGE_ORDER)), c)
    functions = pairs.select(
        "advisory", "path",
        F.struct(
            "name", F.col("before").isNotNull().alias("had_before"), F.col("after").isNotNull().alias("has_after"),
            map_difference(new, old).alias("added_grams"), map_difference(old, new).alias("removed_grams"),
            F.array_except(F.coalesce("after.calls", none), F.coalesce("before.calls", none)).alias("added_calls"),
            F.array_except(F.coalesce("before.calls", none), F.coalesce("after.calls", none)).alias("removed_calls"),
            added_guards(F.coalesce("before.guards", no_guard), F.coalesce("after.guards", no_guard)).alias("added_guards"),
        ).alias("f"),
        F.array_max(F.transform(both, rank)).alias("rank"),
    )
    # maps do not sort: order by name alone
    by_file = functions.groupBy("advisory", "path").agg(F.collect_list("f").alias("functions"), F.max("rank").alias("rank"))
    ordered = F.array_sort("functions", lambda a, b: F.when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0))
    files = by_file.withColumn("functions", ordered).groupBy("advisory").agg(F.collect_list(F.struct("path", "functions")).alias("files"), F.max("rank").alias("rank"))
    in_order = F.array_sort("files", lambda a, b: F.when(a["path"] < b["path"], -1).otherwise(1))
    coverage = F.get(F.array(*(F.lit(x) for x in COVERAGE_ORDER)), (F.col("rank") - 1).cast("int"))
    return files.select("advisory", limit_breadth(in_order, coverage).alias("r")).select("advisory", "r.coverage", "r.files")


def evolution(fixes: DataFrame, commits: DataFrame, commit_files: DataFrame, ancestors: DataFrame | None = None, until: str | None = None) -> DataFrame:
    """(advisory, outcome, horizon, n_later, reverts, backports): what happened to a fix afterwards.

    fixes: (advisory, sha, date); commits: (sha, date, message); commit_files: (sha, path); ancestors: (sha, ancestor)
    of the fixes. Later commits that share a path count, from the fix's date up to the day `until`, but neither the fix
    nor its ancestors. One whose line says that it reverts the fix makes it REVERTED, one that picks it BACKPORTED, else
    the outcome is UNKNOWN. Abbreviated hashes name a fix they begin. The horizon is the last day that counts.
    """
    touched = fixes.join(commit_files, "sha").select("advisory", F.col("sha").alias("fix"), F.col("date").alias("fixed"), "path")
    others = commit_files.join(commits, "sha").select(F.col("sha").alias("later"), "path", "date", "message")
    sharing = touched.join(others, "path").where((F.col("later") != F.col("fix")) & (F.col("date") >= F.col("fixed")))
    if until is not None:
        sharing = sharing.where(F.substring("date", 1, 10) <= until)
    if ancestors is not None:
        past = ancestors.select(F.col("sha").alias("fix"), F.col("ancestor").alias("later"))
        sharing = sharing.join(past, ["fix", "later"], "left_anti")
    distinct = sharing.select("advisory", "fix", "later", "date", "message").distinct()
    names = lambda kind: F.exists(trailers(F.col("message"), kind), lambda h: F.col("fix").startswith(h))
    per_fix = distinct.groupBy("advisory").agg(
        F.countDistinct("later").alias("n_later"),
        F.count_if(names("reverts")).alias("reverts"),
        F.count_if(names("picks") & ~names("reverts")).alias("backports"),
        F.max(F.substring("date", 1, 10)).alias("last"),
    )
    first = fixes.groupBy("advisory").agg(F.max(F.substring("date", 1, 10)).alias("fixed"))
    found = first.join(per_fix, "advisory", "left").fillna(0, ["n_later", "reverts", "backports"])
    outcome = F.when(F.col("reverts") > 0, "REVERTED").when(F.col("backports") > 0, "BACKPORTED").otherwise("UNKNOWN")
    return found.select("advisory", outcome.alias("outcome"), F.greatest("fixed", "last").alias("horizon"), "n_later", "reverts", "backports")


def citations(families: DataFrame, evidence: DataFrame, most: int = 3) -> DataFrame:
    """(family, advisory, sha, kind, place): up to `most` citations of each family.

    families: (family, cwe, examples array); evidence: (advisory, cwe, sha, kind). A record is a
    candidate by its class or as an example: two equi-joins instead of one join with OR. Records of
    the pack come before those of catalogs; each advisory is cited once.
    """
    columns = ["family", "advisory", "sha", "kind"]
    by_class = families.join(evidence, "cwe").select(*columns)
    named = families.select("family", F.explode("examples").alias("advisory"))
    candidates = by_class.unionByName(named.join(evidence, "advisory").select(*columns)).distinct()
    rank = F.when(F.col("kind") == "pack_record", 0).otherwise(1)
    best = F.row_number().over(Window.partitionBy("family", "advisory").orderBy(rank, "sha"))
    place = F.row_number().over(Window.partitionBy("family").orderBy(rank, "advisory", "sha"))
    return candidates.withColumn("_best", best).where("_best = 1").withColumn("place", place).where(F.col("place") <= most).drop("_best")


def guardrail_families(rules: DataFrame, clusters: DataFrame, evidence: DataFrame, most: int = 3) -> DataFrame:
    """(cwe, title, rules, citations, covered): classes that a rule is about, with up to `most` citations of fixes each.

    rules: (rule_id, cwe); clusters: (cwe, title, samples); evidence as for `citations`, of which only full hashes count. A class
    without a cluster goes by its id, and without evidence it is not covered and cites none.
    """
    families = rules.groupBy("cwe").agg(F.array_sort(F.collect_set("rule_id")).alias("rules"))
    named = families.join(clusters.select("cwe", "title", "samples"), "cwe", "left")
    examples = F.coalesce("samples", F.array().cast("array<string>"))
    sound = evidence.where(F.col("sha").rlike("^[0-9a-f]{40}$"))
    cited = citations(named.select(F.col("cwe").alias("family"), "cwe", examples.alias("examples")), sound, most)
    gathered = cited.groupBy(F.col("family").alias("cwe")).agg(F.array_sort(F.collect_list(F.struct("place", "advisory", "sha", "kind"))).alias("citations"))
    none = F.array().cast("array<struct<place:int,advisory:string,sha:string,kind:string>>")
    joined = named.join(gathered, "cwe", "left")
    return joined.select("cwe", F.coalesce("title", "cwe").alias("title"), "rules", F.coalesce("citations", none).alias("citations"), F.col("citations").isNotNull().alias("covered"))
