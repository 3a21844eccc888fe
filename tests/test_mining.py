"""Mining operators and the facade."""

from pyspark.sql import functions as F

from corvane import api
from corvane.functions import lexing
from corvane.operators import intervals, mining

BEFORE = "int helper(int a);\n#ifdef X\nstatic int one(char *b)\n{\n  if (b) { copy(b); }\n  return 1; // }\n}\n#endif\nvoid two(void) {\n  x(\"}\");\n}\n"
AFTER = BEFORE.replace("  return 1; // }", "  if (!b)\n    return 0;\n  return 1; // }")


def test_units_and_spans():
    got = [u[:3] + u[4:] for u in mining.function_units(BEFORE)]
    assert got == [("one", 3, 7, True, "OK"), ("two", 9, 11, False, "OK")]
    assert mining.function_units("int f(void) {\n  {\n")[0][5] == "PARSER_SKIPPED" and mining.function_units("") == []
    assert mining.preprocessor_ranges("#if A\n#if B\n#endif\nx\n#endif\n#if C\n") == [(1, 5), (6, 6)]
    text = "fn f() { unsafe { a({}) } /* unsafe { */ }"
    assert [text[a : b + 1] for a, b in lexing.unsafe_bodies(lexing.code_of(text))] == ["unsafe { a({}) }"]
    text = "unsafe extern \"C\" fn f() { '}' } unsafe impl T for S { } unsafe fn g(); // unsafe {\n'a unsafe { "
    assert [text[a : b + 1] for a, b in lexing.unsafe_bodies(lexing.code_of(text))] == ["unsafe extern \"C\" fn f() { '}' }", "unsafe { "]
    assert lexing.code_of("a/* /* x\n*/ y */b") == "a       \n       b" and lexing.code_of("a/* /* */b*/", nested=False) == "a        b*/"
    literals = 'r#"a"b"#c "x\\"y" \'z\' "open'
    assert lexing.code_of(literals) == " " * 8 + "c" + " " * (len(literals) - 9)


def test_fragments_of_a_fix(spark):
    pairs = spark.createDataFrame([("a.c", BEFORE, AFTER)], "path string, before string, after string")
    lines = intervals.diff_lines(mining.unified_diffs(pairs), ["path"])
    sides = [mining.units(pairs.select("path", F.col(c).alias("text"))).withColumn("side", F.lit(s)) for c, s in (("before", "old"), ("after", "new"))]
    found = mining.attribute_lines(lines, sides[0].unionByName(sides[1])).collect()
    assert [(r.symbol, r.added, r.removed, r.conditional, r.coverage) for r in found] == [("one", 2, 0, True, "OK")]
    ranges = intervals.changed_ranges(lines, ["path"]).where("side = 'new'")
    assert [r.symbol for r in mining.changed_units(sides[1], ranges).collect()] == ["one"]


def test_fix_fingerprints(spark):
    schema = "advisory string, path string, name string, ord int, grams map<string,int>, calls array<string>"
    before = spark.createDataFrame([("A", "a.c", "f", 1, {"x": 9}, []), ("A", "a.c", "f", 2, {"x": 2, "y": 1}, ["p"]), ("A", "a.c", "g", 3, {"z": 1}, [])], schema)
    after = spark.createDataFrame([("A", "a.c", "f", 1, {"x": 1, "w": 1}, ["q"])], schema)
    row = mining.fix_fingerprints(before, after).first()
    f, g = row.files[0].functions
    assert row.coverage == "OK" and (f.name, f.added_grams, f.removed_grams, f.added_calls, f.removed_calls) == ("f", {"w": 1}, {"x": 1, "y": 1}, ["q"], ["p"])
    assert (g.name, g.had_before, g.has_after) == ("g", True, False)


def test_evolution_and_citations(spark):
    sha = "abcdef1234567890"
    fixes = spark.createDataFrame([("A", sha, "2020"), ("B", "b" * 16, "2020")], "advisory string, sha string, date string")
    commits = spark.createDataFrame([(sha, "2020", "fix"), ("b" * 16, "2020", "fix"), ("c1", "2021", "This reverts commit abcdef12."), ("c2", "2021", "other"), ("c0", "2019", "This reverts commit bbbbbbbb")], "sha string, date string, message string")
    files = spark.createDataFrame([(sha, "p"), ("b" * 16, "q"), ("c1", "p"), ("c2", "q"), ("c0", "q")], "sha string, path string")
    got = {r.advisory: (r.outcome, r.n_later) for r in mining.evolution(fixes, commits, files).collect()}
    assert got == {"A": ("REVERTED", 1), "B": ("UNKNOWN", 1)}
    families = spark.createDataFrame([("f", "CWE-1", ["X-9"])], "family string, cwe string, examples array<string>")
    evidence = spark.createDataFrame([("X-1", "CWE-1", "s1", "catalog"), ("X-2", "CWE-1", "s2", "pack_record"), ("X-9", "CWE-2", "s9", "catalog"), ("X-1", "CWE-1", "s0", "pack_record"), ("X-8", "CWE-1", "s8", "catalog")], "advisory string, cwe string, sha string, kind string")
    cited = mining.citations(families, evidence).orderBy("place").collect()
    assert [(r.advisory, r.sha) for r in cited] == [("X-1", "s0"), ("X-2", "s2"), ("X-8", "s8")]


def test_facade(spark):
    rows = [("curl", "CVE-1", "CWE-1", "2020", None, ["s"], "heap overflow read"), ("curl", "CVE-2", "CWE-1", "", "net", [], "heap overflow write"), ("git", "CVE-1", None, "2021", None, [], None), ("git", "CVE-3", "CWE-7", "2019", None, [], "x")]
    atlas = api.with_group(
        spark.createDataFrame(rows, "project string, id string, cwe string, published string, subsystem string, fixes array<string>, text string"),
        spark.createDataFrame([("CWE-1", "Memory Safety")], "cwe string, group string"),
    )
    assert {(r.project, r.n, r.with_fix, r.with_cwe) for r in api.stats(atlas).collect()} == {("curl", 2, 1, 2), ("git", 2, 0, 1), (None, 4, 1, 3)}
    assert [(r.group, r.cwe, r.n, r.group_total) for r in api.tree(atlas).collect()] == [("Memory Safety", "CWE-1", 2, 2), ("Other", "CWE-7", 1, 1), ("Unknown", "UNKNOWN", 1, 1)]
    assert [r.cwe for r in api.tree(atlas, cwe="cwe-7").collect()] == ["CWE-7"] and api.tree(atlas, project="GIT", limit=1).count() == 2
    assert [r.id for r in api.members(atlas, "CWE-1").collect()] == ["CVE-1", "CVE-2"]
    assert api.show(atlas, "CVE-1").first().project == "curl" and api.show(atlas, "CVE-1", "git").first().project == "git"
    assert [r.id for r in api.find(atlas, "curl cwe-1 ", 500).collect()] == ["CVE-1", "CVE-2"]
    assert [r.id for r in api.ask(atlas, "heap read").collect()] == ["CVE-1"] and api.clamp(0) == 1
    assert atlas.where("id = 'CVE-1' and project = 'curl'").first().group_slug == "memory-safety"
