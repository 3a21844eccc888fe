"""Advisory scalars, the atlas, packs and refreshes."""

import hashlib
import json
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from corvane.functions import advisories as A
from corvane.functions import text as T
from corvane.operators import atlas, audit, graph, merging, mining, validating
from corvane.sources import archives, packs, sinks
from corvane.streaming import refresh

SHA = "a" * 40


def values(frame, column):
    return [r.v for r in frame.select(column.alias("v")).collect()]


def test_guards(spark):
    cases = {"cve": ("CVE-2020-1234", "cve-2020-1234", "CVE-2020-12"), "cwe": ("CWE-1", "CWE-", "XCWE-1"), "sha": (SHA, SHA[:-1], "A" * 40), "date": ("2020-01-01", "2020-1-1", "2020-01-01\n"), "project": ("linux-cna", "-x", "")}
    for kind, (good, *bad) in cases.items():
        frame = spark.createDataFrame([(x,) for x in (good, *bad, None)], "x string")
        assert values(frame, A.guarded(F.col("x"), kind)) == [True] + [False] * 3


def test_owners(spark):
    urls = {
        "https://curl.se/x": {"curl"}, "https://GitHub.com/curl/curl/1": {"curl"}, "https://github.com/git/git/x": {"git"}, "https://git.kernel.org/?p=git/git": {"git"},
        "https://lore.kernel.org/git/1": {"git"}, "https://sourceware.org/bugs?x=glibc": {"glibc"}, "https://www.gnu.org/s/libc": {"glibc"}, "https://trac.nginx.org/1": {"nginx"},
        "http://sysoev.ru/x?nginx": {"nginx"}, "https://www.openssh.com/a": {"openssh"}, "https://cdn.openbsd.org/p?openssh": {"openssh"}, "https://openssl.org/": {"openssl"},
        "https://github.com/postgres/postgres": {"postgresql"}, "https://gitlab.com/qemu-project/qemu": {"qemu"}, "https://sqlite.org/src": {"sqlite"}, "https://lists.freedesktop.org/systemd": {"systemd"},
        "https://github.com/NLnetLabs/x": {"unbound"}, "https://nlnetlabs.nl/p/unbound": {"unbound"}, "https://example.org/curl": set(), "https://kernel.org/": set(),
    }
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    flags = [A.owned_by(p, F.lit(None).cast("string"), F.array("u")).alias(p) for p in A.OWNERS]
    for row in frame.select("u", *flags).collect():
        assert {p for p in A.OWNERS if row[p]} == urls[row.u], row.u
        assert urlparse(row.u).netloc
    config = spark.createDataFrame([('{"cpe":"a:git-scm:git"}',), ('{"x":"GNU_C_Library"}',), (None,)], "c string")
    none = F.lit(None).cast("array<string>")
    assert values(config, A.owned_by("git", F.col("c"), none)) == [True, False, False] and values(config, A.owned_by("glibc", F.col("c"), none)) == [False, True, False]


def test_classes_of_feeds(spark):
    schema = "w array<struct<type:string,description:array<struct<value:string>>>>"
    rows = [
        ([("Secondary", [("cwe-79",), ("NVD-CWE-noinfo",)]), ("Primary", [(" cwe-20 ",), ("CWE-20",), ("CWE-22",)])],), ([("Primary", None), ("Primary", [(None,)])],), (None,), ([],),
    ]
    frame = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in values(frame, A.first_cwe(F.col("w")))] == [("CWE-79", "STATED_BY_ADVISORY")] + [(None, "UNKNOWN")] * 3
    first = values(frame, A.cwe_lists(F.col("w")))
    assert tuple(first[0]) == (["CWE-20", "CWE-22"], ["CWE-79"], 1, ["CWE-20", "CWE-22", "CWE-79"]) and tuple(first[2]) == ([], [], 0, [])
    assert values(frame, A.alternates(A.cwe_lists(F.col("w"))["distinct"], F.lit("CWE-22"))) == [2, 0, 0, 0]
    adp = spark.createDataFrame([("CVE-1", [([([("cwe-5", "x"), (None, "CWE-6"), ("", "CWE-5")],)],)]), ("CVE-2", [])], "id string, c array<struct<problemTypes:array<struct<descriptions:array<struct<cweId:string,value:string>>>>>>")
    assert values(adp, A.adp_cwes(F.col("id"), F.lit("CVE-1"), F.col("c"))) == [["CWE-5", "CWE-6"], None]


def test_subsystems_fixes_and_templates(spark):
    frame = spark.createDataFrame([(["x", "https://k.org/NET/a"], ["", "drivers/net/x.c"]), (["a/bpf.c"], ["fs/x.c"]), (["q"], ["/"]), (None, None)], "u array<string>, p array<string>")
    assert values(frame, A.subsystem_of_urls(F.col("u"))) == ["net", "bpf", "unassigned", "unassigned"]
    assert values(frame, A.subsystem_of_paths(F.col("p"))) == ["drivers/net", "fs", "unassigned", "unassigned"]
    patterns = ((r"github\.com/s/s/commit/([0-9a-fA-F]+)", "https://github.com/s/s/commit/"), (r"s\.org/info/([0-9a-fA-F]+)", "https://s.org/info/"))
    refs = [[("WEB", "https://github.com/s/s/commit/" + SHA), ("FIX", "https://s.org/info/abc1"), ("FIX", "https://github.com/s/s/commit/" + SHA)], [("FIX", "http://github.com/s/s/commit/" + SHA.upper())], [("FIX", "z")]]
    frame = spark.createDataFrame([(r,) for r in refs], "r array<struct<type:string,url:string>>")
    got = values(frame, A.fix_reference(F.col("r"), patterns))
    assert [tuple(x) if x else None for x in got] == [("abc1", "https://s.org/info/abc1", False), (SHA, "https://github.com/s/s/commit/" + SHA, True), None]
    text = spark.createDataFrame([("T", ["a", " ", None], ["c"]), (None, None, None)], "t string, l array<string>, c array<string>")
    assert values(text, A.embed_text(F.col("t"), F.col("l"), F.col("c"))) == ["T\na\nc", ""]
    hunks = spark.createDataFrame([("static int f(int a)",), ("if (x)",), ("",), (None,), ("struct s {",)], "h string")
    assert values(hunks, mining.hunk_symbol(F.col("h"))) == ["f", None, None, None, None]
    assert values(spark.range(1), T.query_terms(F.lit("Straße STRASSE x"))) == [["strasse", "x"]]


def test_commits_of_advisories(spark):
    b, c, d = "b" * 40, "c" * 40, "d" * 40
    rows = spark.createDataFrame([("A", [SHA.upper(), "short"], [f"https://x/commit/{c}", "https://x"], ["X"]), ("B", None, None, None), ("C", [d], [], ["A", "Z"])], "advisory_id string, fix_shas array<string>, patch_urls array<string>, aliases array<string>")
    vetted = spark.createDataFrame([("A", [SHA, b])], "advisory_id string, shas array<string>")
    joined = merging.with_commits(rows, vetted)
    assert {r.advisory_id: (r.fix_shas, r.from_vetted) for r in joined.collect()} == {"A": ([SHA, b, c], True), "B": ([], False), "C": ([d], False)}
    mirror = spark.createDataFrame([(SHA,), (b,), (c,)], "sha string")
    assert {r.advisory_id: r.sha_status for r in merging.mirror_status(joined, mirror).collect()} == {"A": "VERIFIED_IN_MIRROR", "B": "NOT_JOINED", "C": "NOT_IN_MIRROR"}
    assert {r.sha_status for r in merging.mirror_status(joined, None).collect()} == {"MIRROR_UNCHECKED", "NOT_JOINED"}
    parents = spark.createDataFrame([(SHA, 1), (b, 2), (c, 1), (d, 0)], "sha string, parents int")
    got = {r.advisory_id: (r.fix_shas, r.fixed_in_shas, r.demoted) for r in merging.single_parent_fixes(joined, parents).collect()}
    assert got == {"A": ([SHA, c], [b], 1), "B": ([], [], 0), "C": ([], [d], 1)}
    with pytest.raises(Exception, match="no parents known"):
        merging.single_parent_fixes(joined, parents.limit(2)).collect()
    documents = spark.createDataFrame([("A", ["1"]), ("X", ["2", "1"]), ("C", ["3"])], "id string, fixed array<string>")
    got = {r.root: (r.found, r.fixed) for r in merging.alias_documents(rows, documents, ("fixed",)).collect()}
    assert got == {"A": (2, ["1", "2"]), "B": (0, []), "C": (2, ["3", "1"])}


def test_atlas(spark):
    entries = spark.createDataFrame([("p", "1", "CWE-1", [SHA]), ("p", "2", "UNKNOWN", []), ("q", "1", "CWE-9", None)], "project string, id string, cwe string, fix_shas array<string>")
    files = "array<struct<path:string,status:string,language:string,before_blob_sha:string,after_blob_sha:string,functions:array<struct<name:string,before_range:array<int>,after_range:array<int>,lines_added:int,lines_removed:int>>>>"
    raw = spark.createDataFrame([("p", "1", [("a.c", None, None, "x", None, [("f", [1, 2], None, 3, None)])]), ("q", "1", None)], f"project string, id string, files {files}")
    fragments = raw.withColumn("fragment", atlas.fragment_shape(F.col("files")))
    shaped = {r.project: r.fragment for r in fragments.collect()}
    assert shaped["q"] == [] and (shaped["p"][0].status, shaped["p"][0].after_blob_sha, shaped["p"][0].functions[0].after_range, shaped["p"][0].functions[0].lines_removed) == ("modified", "", [0, 0], 0)
    side = "struct<start_line:int,end_line:int>"
    prints = spark.createDataFrame([("p", "1", [("a.c", [("f", (1, 5), None, ["x"], None, None)]), ("b.c", None)])], f"project string, id string, files array<struct<path:string,functions:array<struct<name:string,before:{side},after:{side},added_calls:array<string>,removed_calls:array<string>,added_guards:array<string>>>>>")
    prints = prints.withColumn("fingerprint", atlas.fingerprint_shape(F.col("files")))
    (one,) = prints.first().fingerprint
    assert (one.path, one.before_range, one.after_range, one.added_calls, one.removed_calls) == ("a.c", [1, 5], None, ["x"], [])
    joined = {(r.project, r.id): (r.has_fix, r.has_fragments, r.has_fingerprint) for r in atlas.with_details(entries, fragments, prints).collect()}
    assert joined == {("p", "1"): (True, True, True), ("p", "2"): (False, False, False), ("q", "1"): (False, True, False)}
    names = atlas.with_class_names(entries, spark.createDataFrame([("CWE-1", "own"), ("CWE-9", "")], "cwe string, title string"), spark.createDataFrame([("CWE-1", "official")], "cwe string, title string"))
    assert {r.cwe: r.title for r in names.collect()} == {"CWE-1": "official", "CWE-9": "CWE-9", "UNKNOWN": "Unstated or Legacy Advisory Without CWE Classification"}


def test_summaries(spark):
    rows = spark.createDataFrame([("CWE-1", None), ("CWE-2", "nvd-primary"), ("", "nvd-primary"), (None, None), ("CWE-3", "nvd-primary")], "cwe string, cwe_source string")
    assert [tuple(r) for r in atlas.provenance_summary(rows, ("nvd-primary", "cisa-adp")).collect()] == [("catalog", 1), ("nvd-primary", 2), ("cisa-adp", 0), ("unknown", 2)]
    targets = spark.createDataFrame([("1", None, ["linux-cna"]), ("2", "", ["x"]), ("3", "CWE-1", ["linux-cna"]), ("4", None, ["linux-cna", "x"])], "advisory_id string, cwe string, projects array<string>")
    assert tuple(atlas.overlay_summary(targets, spark.createDataFrame([("1",), ("2",)], "advisory_id string")).first()) == (2, 3, 1, 2, 1)
    catalogs = spark.createDataFrame([("a", "COMPLETE", 5, 2, 1), ("b", "COMPLETE", 1, None, 1), ("c", "NOT_FETCHED", 0, 0, 0)], "project string, status string, entries int, with_fix_sha int, requests int")
    row = atlas.manifest_rollup(catalogs).first()
    assert tuple(row)[:4] == (3, 6, 2, 2) and row.states == {"CURSOR_PAUSED": 0, "NOT_FETCHED": 1, "OBSERVED_EMPTY": 0, "COMPLETE": 2, "SNAPSHOT_COMPLETE": 0}
    assert atlas.manifest_rollup(catalogs.limit(0)).first().total_entries == 0
    projects = spark.createDataFrame([("Nginx", "https://g/nginx"), ("w", None), ("lib", "o/cURL")], "name string, repository string")
    known = spark.createDataFrame([("nginx",), ("nginx-upstream",), ("curl-upstream",)], "catalog string")
    assert {r.name: r.catalogs for r in atlas.catalogs_of(projects, known).collect()} == {"Nginx": ["nginx", "nginx-upstream"], "w": [], "lib": ["curl-upstream"]}
    choices = spark.createDataFrame([("p", 0, "zz"), ("p", 1, "nginx-upstream"), ("p", 2, "nginx"), ("q", 0, "zz")], "project string, ord int, catalog string")
    assert [tuple(r) for r in atlas.first_present(choices, known).collect()] == [("p", "nginx-upstream")]
    ids = spark.createDataFrame([("CVE-2019-1", "b"), ("CVE-2004-2", "a"), ("x", "b"), ("y", "a"), ("z", "c")], "id string, s string")
    assert ids.agg(atlas.year_span(F.col("id")).alias("v")).first().v == "2004-2019" and ids.limit(0).agg(atlas.year_span(F.col("id")).alias("v")).first().v == "none"
    assert [tuple(r) for r in atlas.ordered_histogram(ids, "s").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    fragments = spark.createDataFrame([("r", "OK", [("OK", "ast"), ("INCOMPLETE", "hunk")]), ("s", "INCOMPLETE", [])], "record_id string, coverage string, functions array<struct<coverage:string,method:string>>")
    got = {(r.kind, r.value): r.n for r in mining.fragment_histograms(fragments).collect()}
    assert len(got) == 9 and got["record_coverage", "OK"] == got["method", "ast"] == 1 and got["method", "hunk_fallback"] == 0


def test_conversion(spark):
    url, digest = f"https://github.com/o/r/commit/{SHA}", "0" * 64
    good = ("curl", "C-1", SHA, url, digest, "https://x", "2020", "overflow", "CWE-1", None)
    change = lambda **k: tuple(k.get(n, v) for n, v in zip(names, good, strict=True))
    names = ["project", "advisory_id", "fix_sha", "fix_url", "digest", "evidence_url", "observed_at", "family", "cwe", "cwe_state"]
    cases = [good, change(project="git"), change(project=" "), change(fix_sha="x"), change(fix_url="http://x"), change(fix_url="https://x"), change(fix_sha="b" * 40), change(project="zz"), change(digest=None), change(family="")]
    frame = spark.createDataFrame(cases, ", ".join(f"{n} string" for n in names))
    got = atlas.converted(frame, ("curl",), ("curl", "git")).collect()
    assert [r.reason for r in got] == [
        None, None, "missing project", "no valid 40-hex fix SHA", "no https fix URL", "fix URL is not a recognized GitHub commit/blob reference",
        "fix SHA and fix URL disagree", "no declared digest provenance", "source digest is not a sha256", "source record has no pattern family",
    ]
    assert [(r.record_id, r.slug, r.cwe_state, r.claim_status) for r in got[:3]] == [("curl-C-1", "o/r", "UNKNOWN", "observed"), ("git-C-1", "o/r", "ASSIGNED_BY_STUDY", "hypothesis"), (None, None, "ASSIGNED_BY_STUDY", None)]


def test_quality_gate_and_chains(spark):
    h, g = "a" * 64, "b" * 64
    runs = [("ok", 1, h, "PASS"), ("ok", 2, h, "PASS"), ("one", 1, h, "PASS"), ("odd", 1, h, "PASS"), ("odd", 2, g, "PASS"), ("bad", 1, h, "FAIL"), ("bad", 2, h, "FAIL"), ("warn", 1, h, "WARN"), ("warn", 2, h, "WARN"), ("old", 1, h, "PASS"), ("old", 2, h, "PASS"), ("forged", 1, h, "PASS"), ("forged", 2, h, "PASS"), ("half", 1, h, "INCOMPLETE"), ("half", 2, h, "INCOMPLETE")]
    frame = spark.createDataFrame(runs, "target string, run int, head string, verdict string")
    stored = spark.createDataFrame([("ok", h), ("old", g), ("forged", "x")], "target string, head string")
    got = {r.target: (r.status, r.reason) for r in audit.quality_gate(frame, stored).collect()}
    assert got == {"ok": ("AUTHORIZED", None), "one": ("REJECTED", "runs"), "odd": ("REJECTED", "not_reproducible"), "bad": ("REJECTED", "fail"), "warn": ("REJECTED", "warn"), "old": ("STALE", "stale"), "forged": ("REJECTED", "integrity"), "half": ("REJECTED", "incomplete")}
    assert {r.target: r.status for r in audit.quality_gate(frame, strict=False).collect()}["warn"] == "AUTHORIZED"
    rows = [("a", "R-CWE-1-x", "LOW", k, f"s{k}") for k in range(5)] + [("b", "R", "LOW", 1, "t")]
    found = spark.createDataFrame(rows, "path string, rule_id string, severity string, line long, snippet string")
    changed = found.withColumn("snippet", F.when(F.col("line") == 3, "other").otherwise(F.col("snippet")))
    assert audit.chain(found).first().head != audit.chain(changed).first().head == audit.chain(changed.repartition(3)).first().head
    links = {r.path: r.link for r in audit.links(found).collect()}
    last = ""
    for path, rule, severity, line, snippet in rows[:5]:
        digest = hashlib.sha256(json.dumps({"path": path, "rule_id": rule, "severity": severity, "line": line, "snippet": snippet}, separators=(",", ":")).encode()).hexdigest()
        last = hashlib.sha256((last + digest).encode()).hexdigest()
    assert links["a"] == last and links["b"] == {r.path: r.link for r in audit.links(changed).collect()}["b"]
    clusters = spark.createDataFrame([("CWE-1", "Ones", ["CVE-5", "CVE-6"]), ("CWE-2", "Twos", [])], "cwe string, title string, samples array<string>")
    assert {(r.path, r.cwe, r.cluster_title, r.sample) for r in audit.with_samples(found, clusters).collect()} == {("a", "CWE-1", "Ones", "CVE-5"), ("b", None, "Standard Pattern", None)}


def test_records_and_evolution_rules(spark):
    records = spark.createDataFrame([("r", "p", "t"), ("bad id", "p", " ")], "id string, project string, title string")
    nodes = spark.createDataFrame([("r", "n1", "commit", "l", {}), ("r", "n2", "test_observation", "l", {"outcome": "PASS", "command": "c", "revision": "r", "environment": "e"}), ("r", "n3", "zz", "", {})], "record_id string, id string, kind string, label string, attributes map<string,string>")
    edges = spark.createDataFrame([("r", "e1", "n1", "n2", "reverts", "observed", "2020", ["v1"]), ("r", "e2", "n1", "nx", "likes", "refuted", "", []), ("r", "e3", "n1", "n2", "fixes", "unknown", "2020", ["v1", "v1"])], "record_id string, id string, source string, target string, relation string, status string, known_at string, evidence_ids array<string>")
    evidence = spark.createDataFrame([("r", "v1", "a" * 64, "https://x"), ("r", "v2", "z", "http://x")], "record_id string, id string, sha256 string, url string")
    claims = spark.createDataFrame([("r", "c1", "hypothesis", "t", ["v1"]), ("r", "c2", "validated", " ", ["v9"]), ("r", "c3", "observed", "t", None)], "record_id string, id string, status string, text string, evidence_ids array<string>")
    found = {tuple(x) for x in validating.record_violations(records, nodes, edges, evidence, claims).collect()}
    assert found == {
        ("title", "bad id"), ("record_id", "bad id"), ("record_nodes", "bad id"), ("record_evidence", "bad id"), ("node_kind", "r/n3"), ("node_label", "r/n3"),
        ("edge_status", "r/e2"), ("edge_relation", "r/e2"), ("edge_known_at", "r/e2"), ("edge_references", "r/e2"), ("edge_end", "r/e2"), ("edge_references", "r/e3"),
        ("evidence_sha256", "r/v2"), ("evidence_url", "r/v2"), ("claim_text", "r/c2"), ("claim_evidence", "r/c2"), ("claim_references", "r/c3"),
    }
    outcomes = spark.createDataFrame([("r", "REVERTED", "PARTIAL"), ("s", "BACKPORTED", " "), ("t", "MAYBE", "x")], "id string, outcome string, coverage string")
    follow = spark.createDataFrame([("r", "revert", "n1", ["v1"]), ("r", "test_result", "n2", ["v1"]), ("r", "backport", "n1", ["v1"]), ("r", "dispute", "n1", ["v9"]), ("r", "zz", "n9", [])], "record_id string, kind string, node_id string, evidence_ids array<string>")
    found = {tuple(x) for x in validating.evolution_violations(outcomes, follow, nodes, edges, evidence).collect()}
    assert found == {
        ("followup_support", "r/backport/n1"), ("followup_support", "r/dispute/n1"), ("followup_evidence", "r/dispute/n1"), ("followup_kind", "r/zz/n9"), ("followup_node", "r/zz/n9"),
        ("followup_references", "r/zz/n9"), ("followup_support", "r/zz/n9"), ("outcome_support", "s"), ("evolution_coverage", "s"), ("outcome", "t"),
    }
    rows = spark.createDataFrame([("CVE-1", "curl", "2020-05-01", "OK", SHA, f"https://github.com/curl/curl/commit/{SHA}"), ("x", "git", "2019-01-01", "zz", "s", "https://notgithub.com/s")], "advisory_id string, project string, published string, coverage string, fix_sha string, fix_url string")
    found = {tuple(x) for x in validating.slice_violations(rows, "curl", ("github.com", "curl.se"), "2020-01-01", "2020-12-31").collect()}
    assert found == {(f"slice_{r}", "x") for r in ("id", "project", "window", "coverage", "fix", "host")}
    assert {tuple(x) for x in validating.fragment_violations(spark.createDataFrame([("a", "OK", 1, 2, None), ("b", "PARTIAL", 0, 1, "x")], "record_id string, coverage string, start int, stop int, body_sha256 string")).collect()} == {("coverage", "b"), ("range", "b"), ("body", "b")}
    assert {r.rule_id for r in validating.receipt_violations(spark.createDataFrame([("ns", "a/b", "0" * 64), ("N", "../x", "z")], "namespace string, id string, digest string")).collect()} == {"namespace", "digest", "path"}


def test_answers_cite_kept_evidence(spark):
    nodes = spark.createDataFrame([("r", k, f"n{k}") for k in range(4)] + [("s", 0, "m")], "record_id string, ord int, id string")
    edges = spark.createDataFrame([("r", 10, "e1", "n0", "n1", "observed", "2020", ["v1"]), ("r", 11, "e2", "n1", "n2", "observed", "2020", ["v2"]), ("r", 12, "e3", "n2", "n3", "observed", "2022", ["v3"])], "record_id string, ord int, id string, source string, target string, status string, known_at string, evidence_ids array<string>")
    evidence = spark.createDataFrame([("r", f"v{k}", "2020") for k in range(1, 6)], "record_id string, id string, observed_at string")
    claims = spark.createDataFrame([("r", "c1", "validated", ["v4"], "2020"), ("r", "c2", "hypothesis", ["v5"], "2020")], "record_id string, id string, status string, evidence_ids array<string>, known_at string")
    seeds = spark.createDataFrame([("s", 2), ("r", 1)], "record_id string, rank int")
    got = graph.answer(seeds, nodes, edges, evidence, claims, "2021").collect()
    assert [(r.record_id, r.edges, r.claims, r.evidence) for r in got] == [("r", ["e1", "e2"], ["c1"], ["v1", "v2", "v4"]), ("s", [], [], [])]
    few = graph.answer(seeds, nodes, edges, evidence, claims, None, 2, 2).first()
    assert few.truncated and few.edges == ["e1"] and few.evidence == ["v1", "v4"]


def test_packs_and_snapshots(spark, tmp_path):
    folder = str(tmp_path / "pack")
    spark.createDataFrame([("r", "p", "t")], "id string, project string, title string").write.parquet(f"{folder}/records")
    spark.createDataFrame([("r", "n", "commit", "l")], "record_id string, id string, kind string, label string").write.parquet(f"{folder}/nodes")
    spark.createDataFrame([], packs.TABLES["edges"]).write.parquet(f"{folder}/edges")
    spark.createDataFrame([("r", "v", "https://x", "a" * 64, "2020")], "record_id string, id string, url string, sha256 string, observed_at string").write.parquet(f"{folder}/evidence")
    spark.createDataFrame([("r", "c", "observed", "t", ["v"])], "record_id string, id string, status string, text string, evidence_ids array<string>").write.parquet(f"{folder}/claims")
    tables = packs.mount(spark, folder)
    assert spark.sql("select count(*) n from pack_records r join pack_claims c on c.record_id = r.id").first().n == 1 and tables["nodes"].first().attributes is None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    manifest = files.select(F.regexp_replace("path", r"^.*?/pack/", "").alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    packs.mount(spark, folder, manifest)
    with pytest.raises(ValueError, match="manifest"):
        packs.mount(spark, folder, manifest.withColumn("bytes", F.col("bytes") + 1))
    spark.createDataFrame([("r", "c", "refuted", "t", ["v"])], "record_id string, id string, status string, text string, evidence_ids array<string>").write.mode("overwrite").parquet(f"{folder}/claims")
    with pytest.raises(ValueError, match="claim_status"):
        packs.mount(spark, folder)
    snapshot = spark.createDataFrame([("s/1", "p", [("a",), ("b",)])], "schema string, project string, records array<struct<id:string>>")
    assert [r.record.id for r in packs.checked_snapshot(snapshot, {"schema": "s/1", "project": "p"}).collect()] == ["a", "b"]
    for wrong in (snapshot.withColumn("project", F.lit("q")), snapshot.withColumn("records", F.slice("records", 1, 0)), snapshot.withColumn("project", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="the snapshot"):
            packs.checked_snapshot(wrong, {"schema": "s/1", "project": "p"}).collect()
    feed = spark.createDataFrame([(2020, [("a", 1), ("b", 2)]), (2021, [("a", 3), ("c", 4), ("c", 5)])], "year int, items array<struct<id:string,x:int>>")
    assert sorted((r.key, r.year, r.entry.x) for r in archives.first_entries(feed, "items", "id").collect()) == [("a", 2020, 1), ("b", 2020, 2), ("c", 2021, 4)]


def test_canonical_json_and_swaps(spark, tmp_path):
    frame = spark.createDataFrame([(1, ({"b": 1, "a": 2}, [("y", 1)]))], "z int, a struct<m:map<string,int>,l:array<struct<q:string,b:int>>>")
    assert frame.select(sinks.canonical_column(frame).alias("j")).first().j == '{"a":{"l":[{"b":1,"q":"y"}],"m":{"a":2,"b":1}},"z":1}'
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sinks.swap_in_order([(spark.range(3), one), (spark.range(2), two)])
    (tmp_path / "one").rename(tmp_path / "one.old")  # a crash between two renames
    sinks.swap(spark.range(5), one)
    assert spark.read.parquet(one).count() == 5 and spark.read.parquet(two).count() == 2 and not (tmp_path / "one.old").exists()
    sinks.write_entities(spark.range(1000).withColumn("s", F.lit("hot")), str(tmp_path / "e"), "s", ["id"])
    assert spark.read.json(str(tmp_path / "e")).groupBy("s").count().first()["count"] == 1000


def test_refreshes(spark):
    now = [0.0]
    fetched = []

    def fetch(start, end):
        fetched.append(start)
        now[0] += 10
        return 100

    slices = [(f"2020-0{m}", f"2020-0{m}-end") for m in range(1, 7)]
    clock = lambda: now[0]
    assert refresh.run_slices(slices, fetch, refresh.Budget(1000, 3, 10**6, clock)) == ("2020-04", "calls", 300)
    assert refresh.run_slices(slices[3:], fetch, refresh.Budget(15, 99, 10**6, clock), 300) == ("2020-06", "time", 500)
    assert refresh.run_slices(slices[5:], fetch, refresh.Budget(1000, 99, 500, clock), 500)[1] == "bytes"
    assert refresh.run_slices(slices[5:], fetch, refresh.Budget(1000, 99, 501, clock), 500) == (None, None, 600) and fetched == [s for s, _ in slices]
    work = spark.createDataFrame([(k, 10 * k) for k in range(1, 8)], "id int, bytes int")
    assert [r.id for r in refresh.affordable(work, [F.col("id")], "bytes", 5, 65).collect()] == [1, 2, 3]
    answers = spark.createDataFrame([("a", 1, 200), ("b", 2, 503), ("c", 3, 404), ("d", 4, 429), ("e", 5, 200)], "key string, ord int, code int")
    assert {r.key: r.state for r in refresh.until_stopped(answers, "ord").collect()} == {"a": "done", "b": "retry", "c": "failed", "d": "stopped"}
    rows = spark.createDataFrame([("curl", 1, "C-2", False), ("curl", 2, "C-1", True), ("linux-cna", 1, "L-1", False), ("linux-cna", 2, "L-2", False), ("zz", 1, "Z", True)], "project string, ord int, advisory_id string, in_pack boolean")
    assert [r.advisory_id for r in refresh.by_source(rows, ["linux-cna", "curl"]).collect()] == ["C-1", "L-2", "L-1", "C-2"] and refresh.by_source(rows, ["curl"], most=1).count() == 1
    ran = []

    def step(name, *needs, fail=False, optional=False):
        def run():
            ran.append(name)
            if fail:
                raise RuntimeError("no")

        return refresh.Step(name, run, needs, optional)

    plan = [step("cluster", "manifest"), step("fetch"), step("enrich", "fetch", fail=True, optional=True), step("manifest", "enrich"), step("broken", "fetch", fail=True), step("after", "broken"), step("last", "after")]
    states = refresh.run_plan(plan, skip=("fetch",))
    assert states == {"fetch": "skipped", "enrich": "failed: no", "manifest": "done", "cluster": "done", "broken": "failed: no", "after": "blocked", "last": "blocked"} and ran == ["enrich", "manifest", "cluster", "broken"]
    with pytest.raises(ValueError, match="circle"):
        refresh.run_plan([step("a", "b"), step("b", "a")])
    with pytest.raises(ValueError, match="no step"):
        refresh.run_plan([step("a", "zz")])


def test_small_functions(spark):
    import numpy as np

    from corvane.functions import vectors as V
    from corvane.operators import dependencies, intervals, matching, metrics, search
    from corvane.streaming import incremental

    texts = ["", "  ", "ab", "Hello hello", "é漢字 x", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, got in zip(texts, values(frame, V.trigram_embedding(F.col("t"))), strict=True):
        plain = (text or "").strip().lower()
        if not plain:
            assert got is None
            continue
        want = np.zeros(384)
        for k in range(max(1, len(plain) - 2)):
            number = int(hashlib.sha256(plain[k : k + 3].encode()).hexdigest(), 16)
            want[number % 384] += 1 - 2 * (number % 2)
        assert np.allclose(got, want / np.linalg.norm(want))
    units = spark.createDataFrame([(5, [(1, 4, "a"), (3, 9, "b"), (5, 5, "c")]), (0, [])], "line int, u array<struct<start:int,stop:int,name:string>>")
    assert [x and x.name for x in values(units, intervals.first_unit(F.col("line"), F.col("u")))] == ["b", None]
    sets = spark.createDataFrame([([["a"], ["a", "b"]], ["b", "a"]), ([["a"]], ["a", "b"]), ([], ["a"]), ([["x"]], [])], "r array<array<string>>, e array<string>")
    assert values(sets, metrics.any_complete(F.col("r"), F.col("e"))) == [True, False, False, True]
    ids = spark.createDataFrame([("GHSA-1",), ("CVE-1",), ("X",)], "i string")
    assert values(ids, T.rank_of_prefix(F.col("i"), ("CVE-", "GHSA-"))) == [1, 0, 2]
    names = spark.createDataFrame([("Foo__Bar.baz",)], "name string")
    assert dependencies.normal_names(names).first().name == "foo-bar-baz"
    outcomes = spark.createDataFrame([("FAILED",), ("FAILED",), ("OK",)], "outcome string")
    assert incremental.is_outage(outcomes).first().outage and not incremental.is_outage(outcomes.where("outcome = 'OK'")).first().outage
    hits = spark.createDataFrame([("before", "A", True), ("before", "B", False), ("after", "A", False), ("after", "B", True)], "kind string, advisory string, hit boolean")
    assert tuple(matching.self_test(hits).first()) == (0.5, 0.5, 2)
    found = spark.createDataFrame([("a", 1, ["f"], []), ("b", 2, ["f", "g"], ["net"]), ("c", 3, [], []), ("d", 3, None, ["net"])], "id string, score int, s array<string>, p array<string>")
    assert [(r.id, r.weight) for r in search.rerank(found.where("s is not null"), ["f", "g"], ["net"], "s", "p", "id", 2).collect()] == [("b", 10), ("a", 4)]
    hot = spark.createDataFrame([("k", 3, "z"), ("k", 1, "b"), ("k", 1, "a"), ("j", 9, "q")], "k string, at int, v string")
    assert sorted(map(tuple, incremental.first_seen(hot, ["k"], "at").collect())) == [("j", 9, "q", 1), ("k", 1, "a", 3)]


def test_first_seen_of_a_stream(spark, tmp_path):
    from corvane.streaming import incremental

    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 00:01:00")]
    source, schema = str(tmp_path / "in"), "k string, ts timestamp"
    spark.createDataFrame(rows, "k string, ts string").select("k", F.col("ts").cast("timestamp").alias("ts")).coalesce(1).write.parquet(source)
    stream = incremental.first_seen(spark.readStream.schema(schema).parquet(source), ["k"], "ts", "1 hour")
    job = stream.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination(120)
    assert sorted(r.k for r in spark.table("seen").collect()) == ["a", "b"]


def test_evolution_stays_in_its_window(spark):
    sha = "a" * 40
    fixes = spark.createDataFrame([("A", sha, "2020-01-05")], "advisory string, sha string, date string")
    commits = spark.createDataFrame([(sha, "2020-01-05", "fix"), ("c1", "2020-02-01", f"(cherry picked from commit {sha})"), ("c2", "2020-03-01", f"x\n  This reverts commit {sha[:12]}."), ("c3", "2021-01-01", "later"), ("c4", "2020-01-06", "ancestor")], "sha string, date string, message string")
    files = spark.createDataFrame([(s, "p") for s in (sha, "c1", "c2", "c3", "c4")], "sha string, path string")
    past = spark.createDataFrame([(sha, "c4")], "sha string, ancestor string")
    read = lambda **k: tuple(mining.evolution(fixes, commits, files, **k).first())
    assert read(ancestors=past, until="2020-12-31") == ("A", "REVERTED", "2020-03-01", 2, 1, 1)
    assert read(ancestors=past, until="2020-02-28") == ("A", "BACKPORTED", "2020-02-01", 1, 0, 1) and read()[3] == 4
    assert read(until="2020-01-01") == ("A", "UNKNOWN", "2020-01-05", 0, 0, 0)


def test_fingerprints_keep_guards_and_coverage(spark):
    guards = "array<struct<kind:string,line:int,vars:array<string>>>"
    schema = f"advisory string, path string, name string, ord int, grams map<string,int>, calls array<string>, guards {guards}, coverage string"
    before = spark.createDataFrame([("A", "a.c", "f", 1, {"x": 1}, [], [("if", 3, ["a"])], "OK"), ("A", "b.c", "g", 1, {}, [], None, "PARSER_SKIPPED")], schema)
    after = spark.createDataFrame([("A", "a.c", "f", 1, {"x": 1}, [], [("if", 9, ["a"]), ("if", 1, ["b"]), ("if", 2, ["b"])], "OK")], schema)
    row = mining.fix_fingerprints(before, after).first()
    assert row.coverage == "PARSER_SKIPPED" and [tuple(g) for g in row.files[0].functions[0].added_guards] == [("if", ["b"])]
    unit = "int f(int a)\n{\n  return a;\n}\n"
    assert mining.function_units(unit)[0][3] == hashlib.sha256(b"{\n  return a;\n}").hexdigest()
    got = mining.function_units("int g(void) {\n {\n" + unit.replace("f", "h"))
    assert [(u[0], u[5], u[3] is None) for u in got] == [("g", "PARSER_SKIPPED", True), ("h", "OK", False)]
    assert mining.function_units("int f(int a)\n{\n#if X\n a;\n#endif\n}\n")[0][4] is False


def test_families_of_descriptions(spark):
    cases = [("sqlite", "A double free in x", "memory-lifetime"), ("sqlite", "deadlock", "concurrency"), ("sqlite", "zz", "unknown"), ("sqlite", "", "unknown"), ("systemd", "OOB read", "bounds"), ("qemu", "integer issue", "bounds"), ("qemu", "zz", "logic"), ("glibc", "Format string", "parser"), ("glibc", "see CWE-426", "logic")]
    for project, text, want in cases:
        assert values(spark.createDataFrame([(text,)], "t string"), A.pattern_family(project, F.col("t"))) == [want]
    glibc = spark.createDataFrame([("zz", ["CWE-125"]), ("zz", []), ("setuid", ["CWE-190"]), ("zz", ["CWE-1200", None]), ("zz", None), (None, ["CWE-415"])], "t string, c array<string>")
    assert values(glibc, A.pattern_family("glibc", F.col("t"), F.col("c"))) == ["bounds", "logic", "authz", "logic", "logic", "memory-lifetime"]
    stated = A.KNOWN_FAMILIES["qemu"]
    known = spark.createDataFrame([("out-of-bounds race", i) for i in (*stated, "CVE-1")], "t string, i string")
    assert values(known, A.pattern_family("qemu", F.col("t"), None, F.col("i"))) == [*stated.values(), "bounds"] and len(stated) == 8
    assert values(known, A.pattern_family("systemd", F.col("t"), None, F.col("i")))[1] == "bounds"
    classes = spark.createDataFrame([("CWE-125",), ("CWE-401",), ("CWE-7",), (None,)], "c string")
    assert [len(x) for x in values(classes, atlas.preconditions(F.col("c")))] == [1, 1, 0, 0]


def test_measures_and_payloads(spark):
    from corvane.operators import intervals, metrics, rollups, search

    pairs = "array<struct<record:string,evidence:string,url:string,sha256:string>>"
    frame = spark.createDataFrame([(["r"], ["a", "b"], [("r", "a", "u", "h"), ("x", "b", "u", "h"), ("r", "b", "", "h")]), (["r"], [], []), (["r"], ["a"], [("r", "a", "u", "h")] * 2)], f"r array<string>, e array<string>, f {pairs}")
    got = frame.select(metrics.citation_completeness(F.col("r"), F.col("e"), F.col("f")).alias("c"))
    assert [r.c for r in got.collect()] == [0.5, None, 1.0] and tuple(metrics.means(got, ["c"]).first()) == (3, 0.75) and metrics.means(got.limit(0), ["c"]).first().c is None
    reviews = spark.createDataFrame([("i", "a", "x"), ("i", "b", "x"), ("j", "a", "x"), ("j", "b", "y"), ("k", "a", "x"), ("l", None, None)], "id string, reviewer string, expect string")
    row = metrics.reviewer_summary(reviews).first()
    assert (row["items"], row.single, row.unreviewed, row.paired, row.agreed, row.reviewers) == (4, 1, 1, 2, 1, 2)
    found = spark.createDataFrame([("r", 1), ("s", 2)], "id string, score int")
    claims = spark.createDataFrame([("r", "c2"), ("r", "c1"), ("zz", "c9")], "record_id string, claim string")
    assert [(r.id, [c.claim for c in r.claims]) for r in search.with_payload(found, {"claims": claims}, "id").orderBy("score").collect()] == [("r", ["c1", "c2"]), ("s", [])]
    counts = {r.cwe: (r.n, r.projects) for r in rollups.class_counts(spark.createDataFrame([("CWE-1", "p"), ("cwe-1", "p"), (None, "q"), ("CWE-1", "q")], "c string, p string"), "c", "p").collect()}
    assert counts == {"CWE-1": (2, {"p": 1, "q": 1}), "UNKNOWN": (2, {"p": 1, "q": 1})}
    judged = spark.createDataFrame([("a", None), ("a", None), ("b", "no"), ("c", None)], "family string, reason string")
    assert tuple(rollups.slice_summary(judged, "family").first()) == ("WINDOW_SAMPLED", 3, {"a": 2, "c": 1}) and rollups.slice_summary(judged.limit(0), "family").first().coverage == "INCOMPLETE"
    patch = "--- a/x.c\n+++ b/x.c\n@@ -1,2 +1,3 @@ int outer(int a)\n a\n+b\n c\n@@ -9 +10,2 @@\n x\n+y\n"
    lines = intervals.diff_lines(spark.createDataFrame([("x.c", patch)], "path string, patch string"), ["path"])
    units = spark.createDataFrame([], "path string, symbol string, start int, stop int, body_sha256 string, conditional boolean, coverage string, side string")
    assert sorted((r.symbol or "", r.method, r.added, r.coverage) for r in mining.attribute_lines(lines, units).collect()) == [("", "hunk_fallback", 1, "INCOMPLETE"), ("outer", "hunk_fallback", 1, "INCOMPLETE")]
    code = "int f(void) {\n a;\n}\nint g(void) {\n b;\n}\n"
    files = spark.createDataFrame([("x.c", code, code.replace("b;", "c;"))], "path string, old string, new string")
    index = mining.revision_index(*(mining.units(files.select("path", F.col(c).alias("text"))) for c in ("old", "new")))
    assert sorted((r.symbol, r.state) for r in index.collect()) == [("f", "unchanged"), ("g", "changed")]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from corvane import __main__ as command

    path = str(tmp_path / "atlas")
    spark.createDataFrame([("curl", "CVE-1", "CWE-1", "G", "2020", None, ["s"], "heap overflow read")], "project string, id string, cwe string, group string, published string, subsystem string, fixes array<string>, text string").write.parquet(path)
    monkeypatch.setattr(command, "local_session", lambda: spark)
    assert command.main(["--atlas", path, "show", "CVE-1"]) == 0 and json.loads(capsys.readouterr().out)["project"] == "curl"
    assert command.main(["--atlas", path, "stats"]) == 0 and len(capsys.readouterr().out.splitlines()) == 2
    assert command.main(["--atlas", path, "tree", "--cwe", "cwe-1"]) == 0 and command.main(["--atlas", path, "ask", "heap read"]) == 0 and command.main(["--atlas", path, "find", "nothing"]) == 1


def test_site_files(spark, tmp_path):
    from corvane.sources import site

    rows = [("curl", "CVE-2", "CWE-1", "G", "2020-05", "net", True, False, True), ("curl", "CVE-1", None, "U", "", None, False, False, False), ("git", "CVE-1", "CWE-1", "G", "2020", None, True, True, False)]
    atlas_ = spark.createDataFrame(rows, "project string, id string, cwe string, group string, published string, subsystem string, has_fix boolean, has_fragments boolean, has_fingerprint boolean")
    vectors = spark.createDataFrame([("CVE-2", {"b": 1.5, "a": 2.0}), ("CVE-1", {})], "id string, features map<string,double>")
    folder = str(tmp_path / "site")
    site.write_site(atlas_, vectors, folder)
    index = site.load_index(spark, folder).first()
    assert (index.totals.cves, index.totals.projects, index.totals.with_fix, index.totals.with_fragments) == (3, 2, 2, 1)
    assert [(g.name, g.cves, [(c.id, c.cves, [tuple(p) for p in c.projects]) for c in g.cwes]) for g in index.groups] == [("G", 2, [("CWE-1", 2, [("curl", 1), ("git", 1)])]), ("U", 1, [("UNKNOWN", 1, [("curl", 1)])])]
    assert [(p.name, p.cves, [(y.year, y.n) for y in p.years]) for p in index.projects] == [("curl", 2, [("2020", 1)]), ("git", 1, [("2020", 1)])]
    assert [(r.id, r.project) for r in site.load_search(spark, folder).collect()] == [("CVE-1", "curl"), ("CVE-1", "git"), ("CVE-2", "curl")]
    assert spark.sql("select count(*) n from site_search where cwe = 'UNKNOWN'").first().n == 1
    assert [r.value for r in spark.read.text(f"{folder}/vectors").collect()] == ['{"features":{},"id":"CVE-1"}', '{"features":{"a":2.0,"b":1.5},"id":"CVE-2"}']
    assert spark.read.json(f"{folder}/cwe").where("class = 'CWE-1'").count() == 2
    spark.createDataFrame([('{"schema":"other","groups":[]}',)], "value string").write.mode("overwrite").text(f"{folder}/index")
    with pytest.raises(Exception, match="not an index document"):
        site.load_index(spark, folder).collect()


def test_guardrails_and_enrolments(spark):
    rules = spark.createDataFrame([("R2", "CWE-1"), ("R1", "CWE-1"), ("R3", "CWE-2"), ("R4", "CWE-3")], "rule_id string, cwe string")
    clusters = spark.createDataFrame([("CWE-1", "Ones", ["X-9"]), ("CWE-2", "Twos", [])], "cwe string, title string, samples array<string>")
    evidence = spark.createDataFrame([("X-1", "CWE-1", SHA, "catalog"), ("X-9", "CWE-7", "b" * 40, "pack_record"), ("X-2", "CWE-2", "short", "catalog")], "advisory string, cwe string, sha string, kind string")
    got = {r.cwe: (r.title, r.rules, [c.advisory for c in r.citations], r.covered) for r in mining.guardrail_families(rules, clusters, evidence).collect()}
    assert got == {"CWE-1": ("Ones", ["R1", "R2"], ["X-9", "X-1"], True), "CWE-2": ("Twos", ["R3"], [], False), "CWE-3": ("CWE-3", ["R4"], [], False)}
    rows = [
        ("good", ["repo", "primary_contact"], "https://g/x", "a@b.c", ["d@e.f"], "https://h#x", None, None, True), ("Bad", [], None, None, None, None, None, None, None),
        ("odd", ["repo", "zz"], "http://x", None, ["no"], "ftp://x", "../up", "/etc", True), ("bare", ["repo", "primary_contact"], "https://g/x", "a@b.c", None, None, None, None, False),
    ]
    frame = spark.createDataFrame(rows, "name string, keys array<string>, repo string, primary_contact string, auto_ccs array<string>, homepage string, dockerfile string, threat_model string, has_dockerfile boolean")
    got = {r.name: r.problems for r in validating.enrolment_problems(frame).collect()}
    assert got["good"] == [] and got["Bad"] == ["bad name"] and got["bare"] == ["a Dockerfile is required"]
    assert got["odd"] == [
        "unknown field zz", "missing primary_contact", "repo is no https URL", "homepage is no https URL", "dockerfile is no path inside the repository",
        "threat_model is no path inside the repository", "a Dockerfile is given twice", "bad email no",
    ]


def test_reports(spark):
    from corvane.sources import reports

    found = spark.createDataFrame([("a.c", "f", 3, "A-1", 0.95, 0.1, [(7, "n", "copy")], 0.95), ("b.c", "g", 1, "A-2", 0.6, 0.5, [], 0.6)], "file string, name string, start_line int, advisory string, s_before double, s_after double, missing array<struct<line:int,var:string,callee:string>>, score double").orderBy(F.col("score").desc())
    text = reports.findings_report(found)
    assert "2 functions to review: 1 strong" in text and "- line 7: `n` goes to `copy` unchecked" in text and text.index("a.c") < text.index("b.c")
    assert "Only the first 1 are shown" in reports.findings_report(found, 1) and reports.findings_report(found.limit(0)).endswith("No findings.\n")
    clusters = spark.createDataFrame([("CWE-1", "Ones", 3, 2, {"b": 1, "a": 2}, ["X"], ["p"])], "cwe string, title string, n long, with_fix long, projects map<string,long>, examples array<string>, preconditions array<string>")
    assert "3 advisories, 2 with a fix (a 2, b 1)" in reports.clusters_report(clusters)
    families = spark.createDataFrame([("CWE-2", "Twos", ["R2"], [], False), ("CWE-9", "Nines", ["R1"], [(1, "X-1", SHA, "catalog")], True)], "cwe string, title string, rules array<string>, citations array<struct<place:int,advisory:string,sha:string,kind:string>>, covered boolean")
    text = reports.guardrails_report(families)
    assert "1 of 2 families have evidence" in text and text.index("CWE-9") < text.index("CWE-2") and f"X-1 fixed in `{SHA}`" in text
    commits = spark.createDataFrame([("s<1", None, "fix <b>\nmore", ["f"] * 22, []), ("s2", "X", None, None, ["Fixes"])], "sha string, advisory string, message string, files array<string>, signals array<string>")
    page = reports.review_page(commits)
    assert "s&lt;1" in page and "fix &lt;b&gt;" in page and "more</td>" not in page and "and 2 more" in page and "UNBOUND" in page and "<b>" not in page
    spots = audit.hotspots(spark.createDataFrame([("a.c", "R", 4), ("a.c", "R", 2)], "path string, rule_id string, line long"))
    text = reports.threat_report("x", "does y", [], spots, families)
    assert "- `a.c`: 2 findings: R at 2, 4" in text and "- CWE-9: Nines, 1 cited" in text and "CWE-2" not in text and "- not specified" in text
