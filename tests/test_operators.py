"""The library's operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from corvane.functions import lexing
from corvane.functions import text as T
from corvane.functions import vectors as V
from corvane.functions.scores import rounded, scaled
from corvane.operators import audit, comparing, dependencies, graph, intervals, matching, merging, metrics, rollups, search, similarity, validating
from corvane.streaming import incremental


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def texts(*values):
    return F.array(*(F.lit(v) for v in values)).cast("array<string>")


def test_rounding_and_identifiers(spark):
    row = one(spark, scaled(F.lit(0.00015)).alias("a"), rounded(F.lit(0.12346)).alias("b"), T.is_safe_id(F.lit("CVE-1")).alias("c"), T.is_safe_id(F.lit("CVE-1/x")).alias("d"), T.cwe_number(F.lit("CWE-79")).alias("e"), T.cwe_number(F.lit("x")).alias("f"))
    assert tuple(row) == (1, 0.1235, True, False, 79, None)  # 0.00015 is a little less as a double
    sha = "a" * 40
    row = one(spark, T.full_hashes(texts(f"x/{sha.upper()}", f"{sha}b", f"y {sha}")).alias("a"), T.commit_of_url(F.lit(f"https://h/commit/{sha}")).alias("b"), T.commit_of_url(F.lit("https://h/x")).alias("c"), T.repository_slug(F.lit("HTTPS://Git.host/A/b.git/")).alias("d"), T.package_name(F.lit("A_b..C")).alias("e"))
    assert tuple(row) == ([sha], sha, None, "git.host/a/b", "a-b-c")


def test_versions(spark):
    order = ["1.0", "1.2", "1.10", "1.10.1", "2.0"]
    frame = spark.createDataFrame([(v,) for v in random.Random(1).sample(order, 5)], "v string")
    assert [r.v for r in frame.orderBy(T.version_key(F.col("v"))).collect()] == order
    fixed = texts("0.3.2", "0.4.0", "0.2.9")
    row = one(spark, T.first_fixed(F.lit("0.3.1"), fixed).alias("a"), T.first_fixed(F.lit("1.0"), fixed).alias("b"))
    assert tuple(row) == ("0.3.2", "0.2.9, 0.3.2, 0.4.0")


def test_query_terms_gates_and_hashes(spark):
    row = one(spark, T.query_terms(F.lit("Über über a_b CVE")).alias("a"), T.ids_contained(F.lit("x cve-2020-1"), F.lit("CVE-2020-1")).alias("b"), T.ids_contained(F.lit("CVE-2020-12"), F.lit("CVE-2020-1")).alias("c"), T.ids_contained(F.lit("none"), F.lit("")).alias("d"), T.blob_hash(F.lit("hello\n")).alias("e"), T.line_of(F.lit("a\nb\nc"), F.lit(4)).alias("f"))
    assert tuple(row) == (["über", "a_b", "cve"], True, False, True, "ce013625030ba8dba906f756967f9e9ca394464a", 3)
    message = "Fix\n\nFixes: abcdef123456 (\"x\")\nFixes: abcdef1\nfixes: abcdef123457\n  This reverts commit 1234567890.\nSee: This reverts commit abcdefabc1\n(cherry picked from commit aaaaaaa1)\nBackport of: bbbbbbb2\nupstream commit ccccccc3\n"
    row = one(spark, T.trailers(F.lit(message), "fixes").alias("a"), T.trailers(F.lit(message), "reverts").alias("b"), T.trailers(F.lit(message), "picks").alias("c"))
    assert tuple(row) == (["abcdef123456"], ["1234567890"], ["aaaaaaa1", "bbbbbbb2"])


def test_vectors(spark):
    m = lambda d: F.create_map(*(F.lit(x) for kv in d.items() for x in kv)) if d else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    row = one(spark, V.map_cosine(m({"a": 1}), m({"a": 2, "b": 0})).alias("a"), V.map_cosine(m({}), m({})).alias("b"), V.map_cosine(m({}), m({"a": 1})).alias("c"), V.map_difference(m({"a": 3, "b": 1}), m({"a": 1, "b": 1})).alias("d"))
    assert tuple(row) == (1.0, 1.0, 0.0, {"a": 2})
    row = one(spark, V.minhash(texts("x", "y"), 4).alias("a"), V.minhash(texts(), 2).alias("b"), F.aggregate(V.trigram_embedding(F.lit("hello")), F.lit(0.0), lambda t, x: t + x * x).alias("c"), V.trigram_embedding(F.lit(" ")).alias("d"))
    import hashlib

    low = lambda i, k: int(hashlib.sha256(f"{i}:{k}".encode()).hexdigest()[:8], 16)
    assert row.a == [min(low(i, "x"), low(i, "y")) for i in range(4)] and row.b == [2**32 - 1] * 2 and abs(row.c - 1) < 1e-9 and row.d is None
    vector = one(spark, V.trigram_embedding(F.lit("abc")).alias("v")).v
    h = int(hashlib.sha256(b"abc").hexdigest(), 16)
    assert [k for k, x in enumerate(vector) if x] == [h % 384] and vector[h % 384] == (1.0 if h % 2 == 0 else -1.0)


def test_precedence_merge(spark):
    rows = spark.createDataFrame(
        [("a", 1, False, "x", ["s1"]), ("a", 2, True, None, ["s2", "s1"]), ("a", 3, True, "y", None), ("a", 4, False, "z", ["s3"]), ("b", 5, False, None, []), ("b", 6, False, "q", []), ("c", 7, True, "", [])],
        "k string, ord int, auth boolean, cwe string, fix array<string>",
    )
    got = {r.k: (r.cwe, r.fix) for r in merging.merge_catalogs(rows, ["k"], ["cwe"], ["fix"]).collect()}
    assert got == {"a": ("y", ["s1", "s2", "s3"]), "b": ("q", []), "c": ("", [])}


def test_overlay_append_twins_and_aliases(spark):
    base = spark.createDataFrame([("a", "1"), ("b", None), ("c", None)], "id string, cwe string")
    extra = spark.createDataFrame([("a", "9", "nvd"), ("b", "2", "nvd")], "id string, cwe string, src string")
    assert sorted(map(tuple, merging.overlay(base, extra, "id", "cwe", "src").select("id", "cwe", "src").collect())) == [("a", "1", "catalog"), ("b", "2", "nvd"), ("c", None, None)]
    more = spark.createDataFrame([("c", "x", 1), ("d", "second", 2), ("d", "first", 1)], "id string, cwe string, ord int")
    assert sorted(map(tuple, merging.append_missing(base, more, ["id"]).collect()), key=str)[-1] == ("d", "first")
    rows = spark.createDataFrame([("RUSTSEC-1", ["CVE-1"], ["s1"]), ("GHSA-1", ["RUSTSEC-1", "CVE-1"], ["s2"]), ("GHSA-2", ["RUSTSEC-9"], ["s3"])], "advisory_id string, aliases array<string>, fix_shas array<string>")
    folded = {r.advisory_id: (r.aliases, r.fix_shas) for r in merging.fold_twins(rows, "RUSTSEC-").collect()}
    assert folded == {"RUSTSEC-1": (["CVE-1", "GHSA-1"], ["s1", "s2"]), "GHSA-2": (["RUSTSEC-9"], ["s3"])}
    assert merging.with_aliases(rows).where("root = 'GHSA-1'").orderBy("ordinal").select("id").collect()[0].id == "GHSA-1"


def test_alias_components(spark):
    rows = spark.createDataFrame([("l", "GHSA-1", ["CVE-1"], ["1.2"], None), ("l", "X-1", ["CVE-1"], ["1.3", "1.2"], "HIGH"), ("l", "Y-1", [], [], None)], "lock string, id string, aliases array<string>, fixed array<string>, severity string")
    got = sorted((r.primary, r.aliases, r.fixed, r.severity) for r in merging.alias_components(rows, ["lock"]).collect())
    assert got == [("CVE-1", ["GHSA-1", "X-1"], ["1.2", "1.3"], "HIGH"), ("Y-1", [], [], None)]


def test_fit_record(spark):
    urls = texts("u" * 100, "v" * 300, "w" * 300)
    assert len(one(spark, merging.fit_record(F.struct(F.lit("x").alias("id")), urls).alias("u")).u) == 2
    assert one(spark, merging.fit_record(F.struct(F.lit("x" * 600).alias("id")), urls).alias("u")).u is None


def test_bm25_ranks_gates_and_abstains(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha alpha delta"), (3, "beta"), (4, None), (5, "nft_rbtree set")] + [(k, "filler words here") for k in range(10, 40)], "id long, text string")
    assert [r.id for r in search.bm25(docs, "alpha beta", "id", "text").collect()] == [1]
    assert search.bm25(docs, "beta beta", "id", "text").count() == 0 and search.bm25(docs, " !", "id", "text").count() == 0
    assert [r.id for r in search.bm25(docs, "beta", "id", "text", cut_off=-1.0).collect()] == [3, 1]
    assert [r.id for r in search.bm25(docs, "nft_rbtree set", "id", "text").collect()] == [5]
    assert search.with_status(search.bm25(docs, "zzz", "id", "text")).first().status == "ABSTAIN_NO_MATCH"


def test_islands_merges_and_overlaps(spark):
    rows = spark.createDataFrame([("a", n) for n in (1, 2, 2, 4, 6, 7)], "k string, n long")
    assert sorted((r.start, r.stop, r.n) for r in intervals.islands(rows, ["k"], "n").collect()) == [(1, 2, 2), (4, 4, 1), (6, 7, 2)]
    spans = spark.createDataFrame([("a", 1, 3), ("a", 4, 5), ("a", 7, 9), ("a", 8, 8)], "k string, s long, t long")
    assert sorted((r.start, r.stop) for r in intervals.merged_intervals(spans, ["k"], "s", "t").collect()) == [(1, 5), (7, 9)]
    rng = random.Random(3)
    left = [("k", i, s := rng.randint(0, 90), s + rng.randint(0, 25)) for i in range(40)]
    right = [("k", i, s := rng.randint(0, 90), s + rng.randint(0, 25)) for i in range(40)]
    names = lambda p: f"k string, {p} long, {p}_start long, {p}_stop long"
    got = intervals.overlapping(spark.createDataFrame(left, names("l")), spark.createDataFrame(right, names("r")), ["k"], 10)
    want = sorted((a[1], b[1]) for a in left for b in right if a[2] <= b[3] and b[2] <= a[3])
    assert sorted((r.l, r.r) for r in got.collect()) == want


def test_diff_lines_and_ranges(spark):
    patch = "--- a\n+++ b\n@@ -1,3 +1,4 @@ f()\n a\n-b\n+B\n+C\n c\n\\ No newline at end of file\n@@ -10 +11,0 @@\n-z"
    lines = intervals.diff_lines(spark.createDataFrame([("f", patch)], "file string, patch string"), ["file"])
    assert [(r.kind, r.old_line, r.new_line, r.text) for r in lines.orderBy("pos").collect()] == [(" ", 1, 1, "a"), ("-", 2, None, "b"), ("+", None, 2, "B"), ("+", None, 3, "C"), (" ", 3, 4, "c"), ("-", 10, None, "z")]
    assert sorted((r.side, r.start, r.stop) for r in intervals.changed_ranges(lines, ["file"]).collect()) == [("new", 2, 3), ("old", 2, 2), ("old", 10, 10)]


def test_pairs_drift_and_as_of(spark):
    a = spark.createDataFrame([("x", 1, 1), ("x", 2, 2), ("y", 3, 3)], "k string, v int, ord int")
    b = spark.createDataFrame([("y", 4, 1), ("z", 5, 1)], "k string, v int, ord int")
    assert {r.k: (r.before and r.before.v, r.after and r.after.v) for r in comparing.full_outer(a, b, ["k"], "ord").collect()} == {"x": (2, None), "y": (3, 4), "z": (None, 5)}
    assert [r.k for r in comparing.unique_pairs(a, b, ["k"]).collect()] == ["y"]
    one_more = a.unionByName(a.where("k = 'y'"))
    assert [(r.k, r.side) for r in comparing.drift(one_more, a).collect()] == [("y", "missing")] and comparing.drift(a, a).isEmpty()
    assert tuple(comparing.same_ids(a, b, "k").first()) == (False, 1, 1)
    moments = spark.createDataFrame([(None,), ("",), ("2023-01-01",), ("2025-01-01",)], "d string").select(comparing.as_of(F.col("d"), "2024-01-01").alias("ok"))
    assert [r.ok for r in moments.collect()] == [True, False, True, False]
    assert one(spark, comparing.all_valid(texts(), texts("a")).alias("a"), comparing.all_valid(texts("a", "b"), texts("a")).alias("b"))[:] == (True, False)


def test_graph_retrieval_and_reach(spark):
    nodes = spark.createDataFrame([("r", k, f"n{k}") for k in range(1, 7)] + [("s", 1, "n1")], "record_id string, ord long, id string")
    links = [("n1", "n2"), ("n2", "n3"), ("n3", "n4"), ("n4", "n1"), ("n1", "n5"), ("n1", "n6")]
    edges = spark.createDataFrame([("r", k, f"e{k}", a, b) for k, (a, b) in enumerate(links)], "record_id string, ord long, id string, source string, target string")
    got = {r.record_id: r for r in graph.retrieve(nodes, edges, 2, 10).collect()}
    assert got["r"].nodes == [f"n{k}" for k in range(1, 7)] and len(got["r"].edges) == 6 and got["s"].edges == []
    few = graph.retrieve(nodes, edges, 1, 2).where("record_id = 'r'").first()
    assert few.nodes == ["n1", "n2"] and few.edges == ["e0"] and few.truncated
    seeds = spark.createDataFrame([("n3",)], "node string")
    assert {(r.node, r.hop) for r in graph.reach(seeds, edges, 2).collect()} == {("n3", 0), ("n2", 1), ("n4", 1), ("n1", 2)}


def test_graph_retrieval_of_repeated_nodes_is_native(spark):
    def walk(ids, links, hops, most):
        seen, queue = dict.fromkeys(ids[:most], 0), list(dict.fromkeys(ids[:most]))
        for at in queue:
            for other in sorted({b for a, b in links if a == at} | {a for a, b in links if b == at}):
                if other in ids and other not in seen and seen[at] < hops and len(seen) < most:
                    seen[other] = seen[at] + 1
                    queue.append(other)
        return list(seen), [f"e{k}" for k, (a, b) in enumerate(links) if a in seen and b in seen], len(ids) > most

    rng, nodes, edges, expected = random.Random(8), [], [], {}
    for r in range(60):
        ids = [f"n{rng.randrange(9)}" for _ in range(rng.randrange(1, 14))]
        links = [(f"n{rng.randrange(10)}", f"n{rng.randrange(10)}") for _ in range(rng.randrange(9))]
        nodes += [(f"r{r}", k, i) for k, i in enumerate(ids)]
        edges += [(f"r{r}", k, f"e{k}", a, b) for k, (a, b) in enumerate(links)]
        expected[f"r{r}"] = walk(ids, links, 2, 5)
    found = graph.retrieve(
        spark.createDataFrame(nodes, "record_id string, ord long, id string"), spark.createDataFrame(edges, "record_id string, ord long, id string, source string, target string"), 2, 5
    )
    assert {r.record_id: (r.nodes, r.edges, r.truncated) for r in found.collect()} == expected
    assert "Pandas" not in found._jdf.queryExecution().toString()  # a Python group per record took the time


def test_reach_totals_equal_reach_without_rows_of_the_last_hop(spark, monkeypatch):
    rng = random.Random(9)
    edges = [(f"c{rng.randrange(150)}", f"p{min(rng.randrange(40), rng.randrange(40))}") for _ in range(500)] + [("c1", "c1"), (None, "p1"), ("c2", "c3")]
    links = spark.createDataFrame(edges, "source string, target string")
    seeds = spark.createDataFrame([(f"c{k}",) for k in range(150)] + [("alone",)], "node string")
    around = {}
    for a, b in edges:
        if a is not None:
            around.setdefault(a, set()).add(b)
            around.setdefault(b, set()).add(a)
    asked = []
    whole = graph.reach_bits
    monkeypatch.setattr(graph, "reach_bits", lambda roots, edges, hops: asked.append(hops) or whole(roots, edges, hops))
    for hops in (1, 2, 3):
        expected = {}
        for (root,) in seeds.collect():
            seen, at = {root}, {root}
            expected[root, 0] = 1
            for hop in range(1, hops + 1):
                at = {x for node in at for x in around.get(node, ())} - seen
                seen |= at
                if at:
                    expected[root, hop] = len(at)
        roots = graph.numbered_roots(seeds)
        found = graph.reach_totals(roots, links, hops, bucket_arcs=200, block_rows=100)
        assert {(r.root, r.hop): r.n for r in found.collect()} == expected
    assert asked == [0, 1, 2]  # the last step has no rows


def test_valid_parts(spark):
    evidence = spark.createDataFrame([("r", "e1", "2023"), ("r", "e2", "2025"), ("r", "e3", "")], "record_id string, id string, observed_at string")
    claims = spark.createDataFrame([("r", "c1", "observed", ["e1"], None), ("r", "c2", "observed", ["e1", "e2"], None), ("r", "c3", "refuted", [], None), ("r", "c4", "validated", [], None)], "record_id string, id string, status string, evidence_ids array<string>, known_at string")
    known, good, _ = graph.valid_parts(None, claims, evidence, claims, "2024")
    assert [r.id for r in known.collect()] == ["e1"] and sorted(r.id for r in good.collect()) == ["c1", "c4"]


def test_metrics(spark):
    row = one(spark, metrics.reciprocal_rank(texts("a", "b"), texts("b")).alias("a"), metrics.reciprocal_rank(texts("a"), texts("z")).alias("b"), metrics.reciprocal_rank(texts("a"), texts()).alias("c"), metrics.recall_at(texts("a", "b"), texts("b", "z")).alias("d"))
    assert tuple(row) == (0.5, 0.0, None, 0.5)
    votes = spark.createDataFrame([(1, 1)] * 20 + [(1, 0)] * 5 + [(0, 1)] * 10 + [(0, 0)] * 15 + [(None, 1)], "a int, b int")
    assert abs(metrics.cohens_kappa(votes, "a", "b").first().kappa - 0.4) < 1e-9
    assert metrics.cohens_kappa(votes.where("a = 1 and b = 1"), "a", "b").first().kappa is None
    assert metrics.cohens_kappa(votes.limit(0), "a", "b").first().n == 0
    assert metrics.verdict_rates(votes.limit(0), [], "a", ["1"]).first().rate_1 is None


def test_rollups(spark):
    assert one(spark, rollups.maturity([(F.lit(True), 60), (F.lit(True), 30)], F.lit("70")).alias("a"), rollups.maturity([(F.lit(True), 60)], F.lit("x")).alias("b"))[:] == (70, 0)
    assert one(spark, rollups.problems({"a": F.lit(True), "b": F.lit(None).cast("boolean")}).alias("p")).p == ["b"]
    rows = spark.createDataFrame([(k, k % 2) for k in range(30)], "id long, bad long")
    slice_ = rollups.study_slice(rows, [("bad", F.col("bad") == 0)], [F.col("id")], examine=20, keep=3)
    assert [r.reason for r in slice_.orderBy("place").limit(8).collect()] == [None, "bad", None, "bad", None, "bad", "max_records_reached", "bad"]


def test_validators(spark):
    rows = spark.createDataFrame([("CVE-1-1", "2020-01-01", "CWE-1", "stated", ["https://x"], ["a" * 40]), ("bad/id", "x", None, "stated", ["http://x"], ["zz"]), ("CVE-1-1", "", None, "none", [], [])], "advisory_id string, published string, cwe string, cwe_state string, patch_urls array<string>, fix_shas array<string>")
    found = validating.catalog_violations(rows)
    assert sorted(tuple(r) for r in found.collect()) == sorted([(x, "bad/id") for x in ("id", "published", "links", "hashes", "cwe_state")] + [("unique", "CVE-1-1")])
    assert validating.valid_only(rows, found, "advisory_id").count() == 0


def test_lock_files_and_advisories(spark):
    files = [
        ("a/requirements.txt", "# c\nLeft_Pad==1.0  # x\nuvicorn[standard]==0.3.1 ; python_version>'3'\n-r other\nfoo>=1\nbar===1\nuvicorn==0.3.1\nbaz==x1\n"),
        ("b/Cargo.lock", '[[package]]\nname = "a"\nversion = "1.0.0"\nsource = "registry+x"\n\n[[package]]\nname = "mine"\nversion = "0.1.0"\n\n[[package]]\nname = "g"\nversion = "2"\nsource = "git+x"\n'),
        ("c/package-lock.json", '{"packages":{"":{"version":"1"},"node_modules/x":{"version":"1.1"},"node_modules/a/node_modules/@s/y":{"version":"2"},"packages/w":{"version":"5"},"node_modules/l":{"link":true,"version":"1"}}}'),
        ("d/package-lock.json", '{"dependencies":{"x":{"version":"1","dependencies":{"z":{"version":"3"}}}}}'),
        ("e/pnpm-lock.yaml", "lockfileVersion: 6\npackages:\n\n  '@s/a@1.2.0(react@1)':\n    x: 1\n    q@1:\n  'b@2.0.0':\n    y: 1\nother:\n  c@3.0.0:\n"),
        ("i/pnpm-lock.yaml", "packages:\n\n@s/a@1.0.0:\n  peers:\nb@2.0.0:\n  x@9:\nsnapshots:\n  c@1:\n"),
        ("f/go.sum", "h/m v1.2.3 h1:x\nh/m v1.2.3/go.mod h1:y\nh/n v2.0.0+incompatible h1:z\nh/o v1 x\n"), ("g/package-lock.json", "{bad"), ("h/other.txt", "x"),
    ]
    got = dependencies.parse(spark.createDataFrame(files, "path string, text string"))
    by = {}
    for r in got.orderBy("path", "ordinal").collect():
        by.setdefault(r.path[0], []).append((r.ecosystem, r.name, r.version))
    assert by["a"] == [("PyPI", "left-pad", "1.0"), ("PyPI", "uvicorn", "0.3.1")]
    assert by["b"][0] == ("crates.io", "a", "1.0.0") and ("crates.io", "g", "2") not in by["b"]
    assert by["c"] == [("npm", "x", "1.1"), ("npm", "@s/y", "2"), ("npm", "packages/w", "5")] and by["d"] == [("npm", "z", "3"), ("npm", "x", "1")]
    assert by["e"] == [("npm", "@s/a", "1.2.0"), ("npm", "b", "2.0.0")] and by["i"] == [("npm", "@s/a", "1.0.0"), ("npm", "b", "2.0.0")]
    assert by["f"] == [("Go", "h/m", "v1.2.3"), ("Go", "h/n", "v2.0.0")] and not {"g", "h"} & set(by)
    schema = "id string, aliases array<string>, affected array<struct<package:struct<name:string,ecosystem:string>,ranges:array<struct<type:string,events:array<struct<introduced:string,fixed:string>>>>>>, severity array<struct<score:string>>, database_severity string"
    events = lambda *fixed: [("SEMVER", [("0", None), *((None, f) for f in fixed)])]
    advisories = spark.createDataFrame([("GHSA-1", ["CVE-1"], [(("uvicorn", "PyPI"), events("0.3.2", "0.4.0", "0.2.9"))], [], "HIGH"), ("GHSA-2", [], [(("x", None), events())], [("7.5",)], None), ("GHSA-3", [], [(("x", "PyPI"), events())], [], None)], schema)
    found = [(r.path[0], r.name, r.id, r.fix, r.severity) for r in dependencies.findings(got, advisories).collect()]
    assert found == [("a", "uvicorn", "GHSA-1", "0.3.2", "HIGH"), ("c", "x", "GHSA-2", None, "7.5"), ("d", "x", "GHSA-2", None, "7.5")]


def test_audit(spark):
    source = "a // TOKEN = \"0123456789abcdef\"\nb = 'x'\nmail me@ex.org\n"
    frame = spark.createDataFrame([("f", source), ("g", None), ("h", "fine")], "path string, text string")
    found = audit.findings(frame, audit.TEXT_RULES)
    assert sorted((r.path, r.rule_id, r.line) for r in found.collect()) == [("f", "T001-secret", 1), ("f", "T002-email", 3), ("g", "unreadable", 0)]
    code = lexing.code_of(source)
    assert "TOKEN" not in code and len(code) == len(source) and code.count("\n") == 3
    head = audit.chain(found).first()
    assert head.verdict == "INCOMPLETE" and head.head == audit.chain(found.repartition(5)).first().head
    assert audit.chain(found.where("path = 'f'")).first().verdict == "FAIL" and audit.chain(found.limit(0)).first().verdict == "PASS"
    assert [r.path for r in audit.hotspots(found).collect()][0] == "f"


DEFECTS = {
    "SEC-CWE-120-UNBOUNDED-COPY": ("a.c", "strcpy(to, from);"),
    "SEC-CWE-416-USE-AFTER-FREE-C": ("a.cpp", "free(p); use(p);"),
    "SEC-CWE-416-USE-AFTER-FREE-RUST": ("a.rs", "unsafe { libc::free(p); *p = 1; }"),
    "SEC-CWE-78-COMMAND-INJECTION-C": ("a.c", "system(command);"),
    "SEC-CWE-78-COMMAND-INJECTION-PYTHON": ("a.py", "os.system(command)"),
    "SEC-CWE-78-COMMAND-INJECTION-SHELL": ("a.sh", 'eval "$command"'),
    "SEC-CWE-190-INTEGER-OVERFLOW-C": ("a.h", "p = malloc(n * size);"),
    "SEC-CWE-190-INTEGER-OVERFLOW-RUST": ("a.rs", "unsafe fn f() { Vec::with_capacity(n * 8) }"),
    "SEC-CWE-476-NULL-DEREFERENCE-C": ("a.c", "p = malloc(8); *p = 1;"),
    "SEC-CWE-476-NULL-DEREFERENCE-RUST": ("a.rs", "let p = x as *mut u8; unsafe { *p }"),
    "SEC-CWE-362-CONCURRENCY-RACE-C": ("a.c", "mutex_unlock(&m); mutex_lock(&m);"),
    "SEC-CWE-362-CONCURRENCY-TOCTOU-PYTHON": ("a.py", "if os.path.exists(p):\n    with open(p) as f: pass"),
    "SEC-CWE-362-CONCURRENCY-TOCTOU-SHELL": ("a.bash", 'if [ -f "$x" ]; then cat "$x"; fi'),
    "SEC-CWE-125-UNCHECKED-READ-RUST": ("a.rs", "unsafe { a.get_unchecked(1) }"),
    "SEC-CWE-787-UNCHECKED-WRITE-RUST": ("a.rs", "unsafe { a.get_unchecked_mut(1) }"),
    "SEC-CWE-415-DOUBLE-FREE-C": ("a.c", "free(p); free(p);"),
    "SEC-CWE-415-DUPLICATE-OWNERSHIP-RUST": ("a.rs", "unsafe { drop(Box::from_raw(p)); drop(Box::from_raw(p)); }"),
    "SEC-CWE-457-UNINITIALIZED-RUST": ("a.rs", "unsafe { MaybeUninit::<u8>::uninit().assume_init() }"),
}


def test_source_rules(spark):
    assert [r.rule_id for r in audit.SOURCE_RULES] == list(DEFECTS)
    rows = [(f"{k}/{name}", text) for k, (name, text) in enumerate(DEFECTS.values())]
    rows += [
        ("x/safe.rs", "fn f() { a.get_unchecked(1); Vec::<u8>::with_capacity(n * 8) } unsafe impl S {}"),  # outside unsafe code
        ("x/literal.rs", "unsafe { Vec::with_capacity(4 * 8) }"),
        ("x/comment.rs", "unsafe { /* /* */ a.get_unchecked(1) */ \"b.get_unchecked(1)\"; r#\"\" c.get_unchecked(1)\"# }"),
        ("x/closed.rs", "unsafe { let c = '}'; } a.get_unchecked(1)"),
        ("x/other.py", "strcpy(to, from);"),  # another language's rule
        ("x/unknown.txt", "\n  strcpy(to, from);"),
        ("x/text.c", None),
    ]
    found = audit.findings(spark.createDataFrame(rows, "path string, text string"), audit.SOURCE_RULES)
    got = {(r.path, r.rule_id, r.line) for r in found.collect()}
    for k, (rule, (name, _)) in enumerate(DEFECTS.items()):
        assert (f"{k}/{name}", rule, 1) in got
    assert {g for g in got if g[0][0] == "x"} == {("x/unknown.txt", "SEC-CWE-120-UNBOUNDED-COPY", 2), ("x/text.c", "unreadable", 0)}
    assert audit.chain(found.where("path = '0/a.c'")).first().verdict == "FAIL"
    with pytest.raises(ValueError):
        audit.verdict(F.lit("x"), audit.SOURCE_RULES)


def test_snippets_keep_the_whole_line(spark):
    lines = [f"  strcpy(to, from); {'x' * 200}{end}  " for end in "ab"]
    found = [audit.findings(spark.createDataFrame([("a.c", f"int x;\n{t}\n")], "path string, text string"), audit.SOURCE_RULES) for t in lines]
    assert [f.first().snippet for f in found] == [t.strip() for t in lines]
    assert len({audit.chain(f).first().head for f in found}) == 2
    long = audit.findings(spark.createDataFrame([("f", "a" * 200 + "@ex.org b")], "path string, text string"), audit.TEXT_RULES)
    assert long.first().snippet == "a" * 200 + "@ex.org b"


@pytest.mark.parametrize("partitions", [1, 8])
def test_state_hash_does_not_depend_on_partitions(spark, partitions):
    frame = spark.range(100).withColumn("x", F.col("id") % 7).repartition(partitions)
    assert audit.state_hash(frame, ["id", "x"]).first().state == audit.state_hash(spark.range(100).withColumn("x", F.col("id") % 7), ["id", "x"]).first().state


def _function(name, grams, guards=(), nodes=100, signature=None):
    return (name, 1, nodes, grams, signature or [7] * 64, [("copy", 10, ["buf", "len"])], list(guards))


def test_matcher(spark):
    guard = ("if", 8, ["len"])
    schema = f"advisory string, before {matching.FUNCTION}, after {matching.FUNCTION}"
    old, new = {"k1": 2, "k2": 1}, {"k9": 1}
    corpus = spark.createDataFrame([("A-1", _function("f", old), _function("f", new, [guard])), ("A-2", _function("gone", old), None)], schema)
    targets = spark.createDataFrame(
        [("x.c", _function("same", old)), ("fixed.c", _function("f", new, [guard])), ("tiny.c", _function("t", old, nodes=5)), ("far.c", _function("far", old, signature=list(range(64)))), ("y.c", _function("test_x", old))],
        f"file string, function {matching.FUNCTION}",
    )
    got = [(r.file, r.advisory, r.s_before, r.s_after, [tuple(m) for m in r.missing], r.score) for r in matching.match(targets, corpus).collect()]
    assert ("x.c", "A-1", 1.0, 0.0, [(10, "len", "copy")], 1.0) in got and ("x.c", "A-2", 1.0, 0.0, [], 1.0) in got
    assert {g[0] for g in got} == {"x.c", "tiny.c"} and [g[5] for g in got if g[0] == "tiny.c"] == [0.1]
    rules = corpus.where("advisory = 'A-1'").select(matching.missing_guards(F.col("after"), matching.guard_rules(F.col("before"), F.col("after"))).alias("m"))
    assert rules.first().m == []  # a fixed version never breaks its own rule


def slow_rules(before, after):
    added = {(k, tuple(v)) for k, _, v in after[6]} - {(k, tuple(v)) for k, _, v in before[6]}
    callees = {}
    for callee, _, args in after[5]:
        for v in args:
            callees.setdefault(v, set()).add(callee)
    found = set()
    for callee, line, args in after[5]:
        for at, v in enumerate(args):
            near = any((k, tuple(g)) in added and v in g and callee not in g and 0 < line - n <= 8 for k, n, g in after[6])
            if v and not v[0].isupper() and len(callees[v]) < 3 and near:
                found.add((callee, at))
    free = lambda v, line: v and not any(v in g and n < line for _, n, g in before[6])
    return {(c, at) for c, at in found if any(b == c and at < len(a) and free(a[at], n) for b, n, a in before[5])}


def slow_missing(target, rules):
    out = set()
    for callee, line, args in target[5]:
        for at, v in enumerate(args):
            if (callee, at) in rules and v and not v[0].isupper() and not any(v in g and callee not in g and n < line for _, n, g in target[6]):
                out.add((line, v, callee))
    return sorted(out)


def test_guard_rules_equal_plain_loops(spark):
    rng = random.Random(17)

    def function():
        calls = [(rng.choice("fgh"), rng.randint(1, 20), rng.choices(["a", "b", "c", "MAX", ""], k=rng.randint(0, 3))) for _ in range(rng.randint(1, 5))]
        guards = [(rng.choice(("if", "while")), rng.randint(1, 20), rng.sample(["a", "b", "c", "f", "g"], k=rng.randint(1, 2))) for _ in range(rng.randint(0, 4))]
        return ("n", 1, 50, {"k": 1}, [1], calls, guards)

    def fixed(old):
        extra = [("if", rng.randint(1, 20), rng.sample(["a", "b", "c", "f"], k=rng.randint(1, 2))) for _ in range(rng.randint(0, 3))]
        moved = [(k, max(1, n - rng.randint(0, 5)), v) for k, n, v in old[6]]
        return (*old[:5], old[5], moved + extra)

    cases = [(k, b, fixed(b), function()) for k, b in enumerate(function() for _ in range(400))]
    frame = spark.createDataFrame(cases, f"id int, before {matching.FUNCTION}, after {matching.FUNCTION}, target {matching.FUNCTION}")
    ruled = frame.withColumn("rules", matching.guard_rules(F.col("before"), F.col("after")))
    got = {r.id: r for r in ruled.withColumn("missing", matching.missing_guards(F.col("target"), F.col("rules"))).collect()}
    some = 0
    for k, before, after, target in cases:
        rules = slow_rules(before, after)
        some += bool(rules)
        assert {tuple(r) for r in got[k].rules} == rules and [tuple(m) for m in got[k].missing] == slow_missing(target, rules)
    assert some > 30


def test_guard_arguments_are_listed_once_per_function(spark):
    frame = spark.createDataFrame([], f"before {matching.FUNCTION}, after {matching.FUNCTION}, target {matching.FUNCTION}")
    missing = matching.missing_guards(F.col("target"), matching.guard_rules(F.col("before"), F.col("after")))
    plan = frame.select(missing.alias("m"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("flatten(") == 3  # a further one would run per argument


def test_fixes_and_names_of_the_matcher(spark):
    names = ["test_a", "a_test", "check_x", "from_str", "main", "drop", "parse"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.b for r in frame.select(matching.is_boilerplate(F.col("n")).alias("b")).collect()] == [True] * 4 + [False] * 3
    paths = spark.createDataFrame([("a/tests/b.c",), ("tests.c",), ("unit-tests/x",), ("a/contest/b",)], "p string")
    assert [r.b for r in paths.select(matching.is_test_path(F.col("p")).alias("b")).collect()] == [True, False, True, False]
    urls = spark.createDataFrame([("linux", None, "s"), ("curl", None, "s"), ("x", "o/r", "s"), ("y", None, "s")], "project string, repo string, sha string")
    known = F.when(F.col("project") == "curl", "curl/curl")
    got = [r.u for r in urls.select(matching.commit_url(F.col("project"), F.col("repo"), F.col("sha"), known).alias("u")).collect()]
    assert got == ["https://git.kernel.org/linus/s", "https://github.com/curl/curl/commit/s", "https://github.com/o/r/commit/s", None]


def test_document_signatures_equal_brute_force(spark, tmp_path):
    import hashlib
    import re

    from corvane.plans import catalog

    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    documents = [(k, " ".join(base[: 120 - k % 7] + [f"x{k % 5}"] * (k % 4))) for k in range(30)]  # near and exact copies
    documents += [(100, None), (101, "!"), (102, "One two"), (103, " ".join(f"y{i % 3}" for i in range(3000)))]
    documents += [(200 + k, " ".join(f"z{rng.randrange(50)}" for _ in range(40))) for k in range(20)]
    spark.createDataFrame(documents, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()[:8]
    signature, sizes = {}, {}
    for k, text in documents:
        t = re.findall(r"[^\W_]+", (text or "").lower())
        keys = {digest("\x1f".join(t[i : i + 3])) for i in range(max(len(t) - 2, 1))} if t else set()
        sizes[k] = len(keys)
        signature[k] = tuple(min((int(digest(f"{i}:{key}"), 16) for key in keys), default=2**32 - 1) for i in range(64))
    first = {s: min(k for k in signature if signature[k] == s) for s in signature.values()}
    near = {}
    for a in first.values():
        for b in first.values():
            if a < b and any(signature[a][i : i + 4] == signature[b][i : i + 4] for i in range(0, 64, 4)):
                near[a, b] = sum(x == y for x, y in zip(signature[a], signature[b], strict=True)) / 64
    get = lambda name: catalog.queries()[name](spark, str(tmp_path)).collect()
    pairs = lambda name: {(r.left, r.right): r.jaccard for r in get(name)}
    score = lambda found: {p: int(j * 10000 + 0.5) for p, j in found.items()}
    assert {r.doc_id: (r.class_id, r.n_grams) for r in get("document_minhash")} == {k: (first[signature[k]], sizes[k]) for k in signature}
    assert pairs("est_jaccard") == score(near)
    assert pairs("document_lsh_candidates") == score({p: j for p, j in near.items() if j >= 0.3})
    copies = {(first[s], k): 1.0 for k, s in signature.items() if first[s] != k}
    assert copies and pairs("near_duplicate_pairs") == score({p: j for p, j in near.items() if j >= 0.8} | copies)
    # the native expressions agree, counts included
    row = one(spark, V.k_grams(texts("a", "b", "a", "b", "a", "b")).alias("g"), V.k_grams(texts("a")).alias("one"), V.k_grams(texts()).alias("none"))
    assert row.g == {digest("a\x1fb\x1fa"): 2, digest("b\x1fa\x1fb"): 2} and row.one == {digest("a"): 1} and row.none == {}


def test_signatures_are_made_in_the_jvm_by_many_tasks_and_equal_those_of_python(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    texts_ = [None, "", "!", "One", "one two", "Ä\u0301 ß\U0001d400 x\x1fy", "İ i̇ I"] + [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(40))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    documents = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = similarity.text_signatures(documents, "doc_id", "text", 2, 101)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert documents.rdd.getNumPartitions() == 1 and found.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    rows = {r.id: (r.n_grams, r.signature) for r in found.collect()}
    monkeypatch.setattr(similarity, "can_compile", lambda spark: False)
    assert rows == {r.id: (r.n_grams, r.signature) for r in similarity.text_signatures(documents, "doc_id", "text", 2, 101).collect()}
    assert len(rows) == len(texts_) and rows[1] == (0, [2**32 - 1] * 101) and rows[3][0] == 1


def test_hashes_of_whole_arrays_equal_hashlib(monkeypatch):
    import hashlib

    import numpy as np
    import pyarrow as pa

    keys = np.random.default_rng(5).integers(0, 2**32, 70, np.uint32)
    monkeypatch.setattr(V, "LANES", 32)  # three parts, the last one short
    prefixes = [b"", b"7:", b"63:", b"100:", b"1000:", b"123456789:"]
    for prefix, found in zip(prefixes, V.hash_words(keys, prefixes), strict=True):
        assert found.tolist() == [int.from_bytes(hashlib.sha256(prefix + b"%08x" % key).digest()[:4]) for key in keys.tolist()]
    # blocks end with a row, wherever that is; rows without a word, and equal keys of several rows
    tokens = ["a\x1fb\x1fc\x1fd", "", "b\x1fc\x1fd", "x", "", "a\x1fb\x1fc"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6), pa.int64()), pa.array(tokens)], names=["id", "tokens"])
    whole = [r for b in similarity._signatures(3, 8)(iter([batch])) for r in b.to_pylist()]
    for most in (1, 2, 3):
        assert [r for b in similarity._signatures(3, 8, most)(iter([batch])) for r in b.to_pylist()] == whole
    digest = lambda t: hashlib.sha256(t.encode()).digest()[:4]
    for row, joined in zip(whole, tokens, strict=True):
        words = joined.split("\x1f") if joined else []
        grams = {digest("\x1f".join(words[i : i + 3])).hex() for i in range(max(len(words) - 2, 1))} if words else set()
        assert row["n_grams"] == len(grams)
        assert row["signature"] == [min((int.from_bytes(digest(f"{i}:{g}")) for g in grams), default=2**32 - 1) for i in range(8)]


def test_advisories_fold_once_per_package(spark, monkeypatch):
    package = lambda name, eco: {"package": {"name": name, "ecosystem": eco}, "ranges": [{"events": [{"fixed": "1.5"}, {"fixed": "1.10"}, {"fixed": None}]}]}
    advisories = spark.createDataFrame(
        [
            ("GHSA-1", ["CVE-1"], [package("a", "npm"), package("b", None)], [("7.5",)], None),
            ("RUSTSEC-1", ["CVE-1", "X-1"], [package("a", None)], None, "HIGH"),
            ("GHSA-2", None, [package("a", "npm")], None, None),
            ("PYSEC-3", ["X-3"], [package("b", "PyPI"), package("b", "PyPI")], None, "LOW"),
        ],
        "id string, aliases array<string>, affected array<struct<package:struct<name:string,ecosystem:string>,ranges:array<struct<events:array<struct<fixed:string>>>>>>, severity array<struct<score:string>>, database_severity string",
    )
    rows = [(f"p{k % 4}", k, eco, name, version) for k, (eco, name, version) in enumerate((e, n, v) for e in ("npm", "PyPI", None) for n in ("a", "b", "c") for v in ("1.2", "1.9", "2", None) for _ in range(3))]
    locked = spark.createDataFrame(rows, dependencies.DEPENDENCY)
    folded = []

    def fold(found, *args, **named):
        folded.append(found.count())
        return merging.alias_components(found, *args, **named)

    monkeypatch.setattr(dependencies, "alias_components", fold)
    slow = dependencies.vulnerabilities(dependencies.findings(locked, advisories))
    quick = dependencies.package_vulnerabilities(locked, advisories)
    text = lambda frame: sorted(map(repr, frame.select(slow.columns).collect()))
    assert text(quick) == text(slow) and len(text(slow)) > 10
    assert folded[1] == (3 + 1) + (1 + 2) + (1 + 1) < folded[0]  # a and b of npm, PyPI and no ecosystem


def test_record_features(spark):
    schema = "key long, cwe string, project string, subsystem string, files array<struct<path: string, functions: array<string>>>, changes array<struct<name: string, calls: array<string>, grams: array<string>>>"
    rows = [
        (1, "CWE-416", "Curl", None, [("README", None), ("Lib/url_parse.c", ["Free_It"])], [("free_it", ["Kfree", "kfree"], ["AB"])]),
        (2, "UNKNOWN", None, "Net", [("drivers/x.c", None)], None),
        (3, "999", "", None, None, None),
        (4, None, None, None, [], []),
    ]
    got = {}
    for r in similarity.record_features(spark.createDataFrame(rows, schema)).collect():
        assert (r.key, r.feature) not in {(k, f) for k, v in got.items() for f in v}
        got.setdefault(r.key, {})[r.feature] = r.weight
    assert got == {
        1: {"cwe:CWE-416": 3, "fam:memory-safety": 2, "proj:curl": 1, "sub:lib": 2, "path:readme": 1, "path:lib": 1, "path:url": 1, "path:parse": 1, "fn:free_it": 3, "fixcall:kfree": 2, "kg:ab": 1},
        2: {"sub:net": 2, "path:drivers": 1},
        3: {"cwe:999": 3, "fam:other": 2},
    }
    many = [(k, None, None, None, None, [("f", ["shared"] if k < 2 else [f"c{k}"], None)]) for k in range(60)]
    found = similarity.related(similarity.record_features(spark.createDataFrame(many, schema)), F.col("key") == 0)
    assert [(r.key, r.other) for r in found.collect()] == [(0, 1)]  # they share a callee only


def test_iterated_graph_retrieval(spark):
    part = "array<struct<id: string, source: string, target: string>>"
    answers = {
        "q": [("r1", 1, [("e2", None, None)], [("p1", "file:b", "symbol:a"), ("p0", "c", "x:q")], None)],
        "a": [("r2", 1, [], [], None), ("r1", 2, [("e1", None, None), ("e2", "new", None)], [], None)],
        "b": [("r3", 1, [], [("p9", "z", "z")], None), ("r2", 2, [], [], None)],
    }
    asked = []

    def search(text):
        asked.append(text)
        return spark.createDataFrame(answers[text], f"id string, rank int, evidence {part}, paths {part}, claims {part}")

    got = graph.iterate(search, "q").collect()
    assert asked == ["q", "a", "b"] and [(r.id, r.call) for r in got] == [("r1", 0), ("r2", 1), ("r3", 2)]
    assert [tuple(e) for e in got[0].evidence] == [("e1", None, None), ("e2", "new", None)]
    assert [p.id for p in got[0].paths] == ["p0", "p1"] and [r.id for r in graph.iterate(search, "q", limit=1).collect()] == ["r1"]


def test_lsh_and_nearest(spark):
    prints = spark.createDataFrame([(1, [1] * 64), (2, [1] * 32 + [2] * 32), (3, list(range(64))), (4, [])], "id long, signature array<long>")
    prints = prints.unionByName(spark.createDataFrame([(5, [1] * 64), (6, None), (7, [3] * 64), (8, [3] * 64)], prints.schema))
    left, right, near = similarity.lsh_classes(prints, prints)
    got = {(r.left_class, r.right_class): r.jaccard for r in near.collect()}
    assert got["1", "2"] == 0.5 and ("1", "3") not in got and got["", "3"] is None and got["1", ""] is None and got["", ""] is None
    assert near.count() == len(got) == 4 + 2 + 9  # equal signatures are one class, and so are the unusable rows
    assert {(r.class_id, r.id) for r in left.collect()} == {("1", 1), ("1", 5), ("2", 2), ("3", 3), ("7", 7), ("7", 8), ("", 4), ("", 6)} == {(r.class_id, r.id) for r in right.collect()}
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(60)] + [(99, None), (100, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").repartition(5)
    got = similarity.nearest(frame.where("id < 5"), frame, 4, block=2)
    import numpy as np

    unit = {k: np.array(v) / (np.linalg.norm(v) or 1) for k, v in rows if v}
    for q in range(5):
        want = sorted((k for k in unit if k != q), key=lambda k: (-float(unit[q] @ unit[k]), k))[:4]
        assert [r.id for r in got.where(F.col("query") == q).orderBy("rank").collect()] == want


def test_incremental(spark, tmp_path):
    state = spark.createDataFrame([("a", "2020-01-01", "2020-07-01", None), ("b", "2020-01-01", "2020-03-01", "2020-02-01"), ("c", "2020-01-01", "2020-01-31", "2020-01-31")], "id string, start string, stop string, cursor string")
    got = sorted((r.id, str(r.slice_start), str(r.slice_stop)) for r in incremental.window_slices(state).collect())
    assert got == [("a", "2020-01-01", "2020-03-30"), ("a", "2020-03-31", "2020-06-28"), ("a", "2020-06-29", "2020-07-01"), ("b", "2020-02-02", "2020-03-01")]
    closed = incremental.reopened(state.withColumn("status", F.lit("COMPLETE")), "2021-01-01").where("id = 'b'").first()
    assert (closed.start, closed.stop, closed.cursor, closed.status) == ("2020-03-02", "2021-01-01", None, "CURSOR_PAUSED")
    with pytest.raises(Exception):
        incremental.reopened(state.withColumn("status", F.lit("COMPLETE")), "2019-01-01").collect()
    history = one(spark, incremental.error_history(texts(*map(str, range(50))), texts("3", "new")).alias("h")).h
    assert len(history) == 50 and history[-1] == "new" and history[0] == "1"
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, t int, v string")
    fresh = spark.createDataFrame([("a", 1, "new"), ("b", 4, "old"), ("c", 1, "z")], "k string, t int, v string")
    assert sorted(tuple(r) for r in incremental.upsert(stored, fresh, "k", "t").collect()) == [("a", 1, "new"), ("b", 5, "y"), ("c", 1, "z")]
    states = spark.createDataFrame([("a", "done"), ("b", "failed")], "k string, state string")
    work = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, ord int")
    assert [r.k for r in incremental.pending(work, states, "k").collect()] == ["c"] and [r.k for r in incremental.pending(work, states, "k", retry=True).collect()] == ["b", "c"]


def test_stream_upserts_resume(spark, tmp_path):
    source, table, marks = f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/marks"
    schema = "k string, t int, v string"
    kept = {}

    def write(frame):
        kept["rows"] = [tuple(r) for r in frame.collect()]

    def read():
        return spark.createDataFrame(kept["rows"], schema) if "rows" in kept else None

    def run():
        incremental.stream_upserts(spark.readStream.schema(schema).json(source), "k", "t", read, write, marks).awaitTermination(60)

    spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], schema).write.json(source)
    run()
    spark.createDataFrame([("a", 2, "newer"), ("b", 0, "older")], schema).write.mode("append").json(source)
    run()
    assert sorted(kept["rows"]) == [("a", 2, "newer"), ("b", 1, "y")] and table


def test_watermarked_windows(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 05:00:00", "b", 3.0)], "at string, kind string, value double")
    events.withColumn("at", F.col("at").cast("timestamp")).write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("at timestamp, kind string, value double").parquet(f"{tmp_path}/e")
    counts = incremental.tumbling_counts(stream, "at", "1 hour", ["kind"], late="10 minutes")
    query = counts.writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [(r.kind, r.n, r.value) for r in spark.table("windows").collect()] == [("a", 2, 3.0)]
