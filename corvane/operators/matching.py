"""Structural matching of function fingerprints against pairs of vulnerable and fixed versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scores import rounded
from corvane.functions.vectors import map_cosine
from corvane.operators.similarity import lsh_classes

CALLS = "array<struct<callee:string,line:int,args:array<string>>>"
GUARDS = "array<struct<kind:string,line:int,vars:array<string>>>"
FUNCTION = f"struct<name:string,start_line:int,node_count:int,grams:map<string,int>,signature:array<bigint>,calls:{CALLS},guards:{GUARDS}>"

# Thresholds and limits of the matcher.
MIN_BEFORE, MARGIN, MIN_NODES, NEAR = 0.55, 0.05, 40, 0.3
DELETED = 0.9
GUARD_REACH, MANY_CALLEES = 8, 3
MISSING_GAIN = 0.1


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once per row: a lambda that names an expression computes it again per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _arguments(function: Column) -> Column:
    """array of (callee, line, at, var) of all call arguments."""
    per_call = F.transform(
        function["calls"],
        lambda c: F.transform(
            c["args"], lambda v, i: F.struct(c["callee"].alias("callee"), c["line"].alias("line"), i.alias("at"), v.alias("var"))
        ),
    )
    return F.flatten(per_call)


def _guarded(guards: Column, arg: Column, reach: int | None = None, precondition: bool = False) -> Column:
    """Whether one of the guards checks the argument's variable before its call, within `reach` lines if given.

    A precondition must not name the callee: such a guard checks the call's own result.
    """

    def test(g: Column) -> Column:
        gap = arg["line"] - g["line"]
        fits = F.array_contains(g["vars"], arg["var"]) & (gap > 0)
        if reach is not None:
            fits = fits & (gap <= reach)
        if precondition:
            fits = fits & ~F.array_contains(g["vars"], arg["callee"])
        return fits

    return F.exists(guards, test)


def _variable(arg: Column) -> Column:
    """Whether an argument is a variable: not empty, and not capitalised as constants are."""
    return (F.coalesce(arg["var"], F.lit("")) != "") & ~F.coalesce(arg["var"], F.lit("")).rlike("^[A-Z]")


def guard_rules(before: Column, after: Column) -> Column:
    """array of (callee, at): argument places that a guard which the fix added checks just before the
    call, while the vulnerable version has such an argument without any guard before it.

    A guard that the fix only moved, of the same kind and variables, is not added. Variables that go to
    `MANY_CALLEES` or more callees are context handles and make no rule.
    """
    same = lambda a, b: (a["kind"] == b["kind"]) & (a["vars"] == b["vars"])
    added = F.filter(after["guards"], lambda g: ~F.exists(before["guards"], lambda old: same(g, old)))
    sides = F.struct(_arguments(after).alias("after"), _arguments(before).alias("before"), added.alias("added"))

    def is_rule(a: Column, sides: Column) -> Column:
        callees = F.size(F.array_distinct(F.transform(F.filter(sides["after"], lambda x: x["var"] == a["var"]), lambda x: x["callee"])))
        unguarded = F.exists(
            sides["before"],
            lambda b: (b["callee"] == a["callee"]) & (b["at"] == a["at"]) & (b["var"] != "") & ~_guarded(before["guards"], b),
        )
        return _variable(a) & _guarded(sides["added"], a, GUARD_REACH, True) & (callees < MANY_CALLEES) & unguarded

    found = bound(sides, lambda s: F.filter(s["after"], lambda a: is_rule(a, s)))
    rules = F.transform(found, lambda a: F.struct(a["callee"].alias("callee"), a["at"].alias("at")))
    return F.when(before.isNull() | after.isNull(), F.array().cast("array<struct<callee:string,at:int>>")).otherwise(F.array_distinct(rules))


def missing_guards(target: Column, rules: Column) -> Column:
    """array of (line, var, callee), sorted: calls of the target that fall under a rule, with no precondition before them."""
    def falls(rules: Column) -> Column:
        return F.filter(
            _arguments(target),
            lambda a: _variable(a)
            & F.exists(rules, lambda r: (r["callee"] == a["callee"]) & (r["at"] == a["at"]))
            & ~_guarded(target["guards"], a, None, True),
        )

    found = F.transform(bound(rules, falls), lambda a: F.struct(a["line"].alias("line"), a["var"].alias("var"), a["callee"].alias("callee")))
    return F.array_sort(F.array_distinct(found))


# Names of functions that every project has alike, and folders of tests.
BOILERPLATE = (
    "fmt", "clone", "clone_from", "eq", "ne", "cmp", "partial_cmp", "hash",
    "default", "from", "into", "try_from", "try_into", "as_ref", "as_mut",
    "deref", "deref_mut", "borrow", "borrow_mut", "to_string", "from_str",
)
TEST_FOLDERS = ("test", "tests", "testsuite", "unittests", "unit-tests")


def is_boilerplate(name: Column) -> Column:
    """Tests and trait implementations are no targets."""
    return name.startswith("test_") | name.endswith("_test") | name.startswith("check_") | name.isin(*BOILERPLATE)


def is_test_path(path: Column) -> Column:
    """Whether a folder of the path is one of tests; fixes of such files make no fingerprint."""
    parts = F.split(path, "/")
    return F.exists(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: p.isin(*TEST_FOLDERS))


def slim_function(function: Column) -> Column:
    """A function without its variables, which only reports on targets need."""
    return function.dropFields("vars")


def commit_url(project: Column, repository: Column, sha: Column, default: Column | None = None) -> Column:
    """The URL of a fix: the kernel's own for its projects, else that of the repository, or of the project's default; null if neither is known."""
    slug = F.coalesce(repository, default) if default is not None else repository
    return F.when(project.isin("linux", "linux-cna"), F.concat(F.lit("https://git.kernel.org/linus/"), sha)).otherwise(
        F.concat(F.lit("https://github.com/"), slug, F.lit("/commit/"), sha)
    )


def match(
    targets: DataFrame,
    corpus: DataFrame,
    min_before: float = MIN_BEFORE,
    margin: float = MARGIN,
    min_nodes: int = MIN_NODES,
) -> DataFrame:
    """(file, name, start_line, advisory, s_before, s_after, missing, score), best first.

    targets: (file, function); corpus: (advisory, before, after), after null for deleted functions.
    LSH bands find candidates, the cosine of the k-gram counts judges them: the target must be
    nearer to the vulnerable version by `margin`, or miss a guard that the fix added. A deleted
    function needs a cosine of `DELETED`. Missing node counts count as large.
    """
    big = lambda c: F.coalesce(c["node_count"], F.lit(min_nodes)) >= min_nodes
    mine = targets.withColumn("id", F.concat_ws("\x1f", "file", F.col("function.name"), F.col("function.start_line").cast("string")))
    left, right, near = lsh_classes(
        mine.select("id", F.col("function.signature").alias("signature")),
        corpus.where("before is not null").select(F.col("advisory").alias("id"), F.col("before.signature").alias("signature")),
        NEAR,
    )
    pairs = (
        near.select("left_class", "right_class")
        .join(left.select(F.col("class_id").alias("left_class"), "id"), "left_class")
        .join(right.select(F.col("class_id").alias("right_class"), F.col("id").alias("advisory")), "right_class")
        .join(mine, "id").join(corpus, "advisory")
        .where(~is_boilerplate(F.col("function.name")))
    )
    judged = (
        pairs.withColumn("s_before", map_cosine(F.col("function.grams"), F.col("before.grams")))
        .withColumn("s_after", F.when(F.col("after").isNotNull(), map_cosine(F.col("function.grams"), F.col("after.grams"))).otherwise(0.0))
        .withColumn("missing", missing_guards(F.col("function"), guard_rules(F.col("before"), F.col("after"))))
    )
    sized = big(F.col("function")) & big(F.col("before"))
    near_enough = F.when(F.col("after").isNull(), F.col("s_before") >= DELETED).otherwise(
        (F.col("s_before") >= min_before) & (F.col("s_before") >= F.col("s_after") + margin)
    )
    base = F.when(sized & (F.col("s_before") >= F.col("s_after")), F.col("s_before")).otherwise(0.0)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), base + MISSING_GAIN * F.size("missing")))
    return (
        judged.where((sized & near_enough) | ((F.size("missing") > 0) & (F.col("s_before") >= min_before)))
        .select(
            "file", F.col("function.name").alias("name"), F.col("function.start_line").alias("start_line"), "advisory",
            rounded(F.col("s_before")).alias("s_before"), rounded(F.col("s_after")).alias("s_after"), "missing", rounded(score).alias("score"),
        )
        .orderBy(F.col("score").desc(), "file", "name", "start_line", "advisory")
    )


def self_test(found: DataFrame) -> DataFrame:
    """One row: the share of vulnerable versions found and of fixed versions flagged, from (kind, advisory, hit)."""
    rate = lambda kind: F.avg(F.when(F.col("kind") == kind, F.col("hit").cast("double")))
    return found.agg(rate("before").alias("before_recall"), rate("after").alias("after_flagged"), F.countDistinct("advisory").alias("n_pairs"))
