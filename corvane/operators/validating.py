"""Validators as tables of violations: (rule_id, id), one select per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The words that records may use.
STATUSES = ("observed", "hypothesis", "validated", "unknown")
NODE_KINDS = ("repository", "advisory", "commit", "code_version", "pattern", "test_observation", "review_observation")
RELATIONS = ("parent_of", "fixes", "fixed_by", "changes", "before", "after", "backport_of", "reverts", "supersedes", "affects", "supports", "refutes")
OUTCOMES = ("UNKNOWN", "REFINED", "REVERTED", "BACKPORTED", "FIXED_STABLE", "TEST_SUPPORTED", "DISPUTED")
FOLLOW_UPS = ("test_result", "revert", "backport", "path_followup", "fix_followup", "dispute")
#: What an outcome needs among the follow-ups.
NEEDED = {"FIXED_STABLE": "test_result", "BACKPORTED": "backport", "TEST_SUPPORTED": "test_result", "REVERTED": "revert", "REFINED": "fix_followup", "DISPUTED": "dispute"}
#: Relations of an edge that supports a follow-up on a commit.
SUPPORTING = {"path_followup": ("changes",), "revert": ("reverts",), "backport": ("backport_of",), "fix_followup": ("fixes", "supersedes")}
COVERAGES = ("OK", "PARSER_SKIPPED", "INCOMPLETE", "TOO_BROAD")
CATALOG_COLUMNS = ("advisory_id", "published", "cwe", "cwe_state", "patch_urls", "fix_shas", "subsystem")


def violations(frame: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule_id, id) for every rule that a row fails; a null test fails. One pass over the rows."""
    failed = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items())))
    return frame.select(F.explode(failed).alias("rule_id"), F.col(key).cast("string").alias("id"))


def duplicates(frame: DataFrame, key: str, rule_id: str) -> DataFrame:
    return frame.groupBy(F.col(key).cast("string").alias("id")).count().where("count > 1").select(F.lit(rule_id).alias("rule_id"), "id")


def dangling(frame: DataFrame, key: str, reference: Column, parents: DataFrame, parent_key: str, rule_id: str) -> DataFrame:
    """Rows one of whose references (an array) names no parent."""
    used = frame.select(F.col(key).cast("string").alias("id"), F.explode(reference).alias("_ref"))
    known = parents.select(F.col(parent_key).alias("_ref")).distinct()
    return used.join(known, "_ref", "left_anti").select(F.lit(rule_id).alias("rule_id"), "id").distinct()


def valid_only(frame: DataFrame, found: DataFrame, key: str) -> DataFrame:
    bad = found.select("id").distinct()
    return frame.join(bad, F.col(key).cast("string") == bad["id"], "left_anti")


def catalog_violations(rows: DataFrame) -> DataFrame:
    """Violations of advisory rows: ids, dates, https links, full hashes, stated classes, unique ids."""
    rules = {
        "id": F.col("advisory_id").rlike(r"^[A-Z][A-Z0-9]*-[A-Za-z0-9-]+$"),
        "published": F.col("published").isNull() | (F.col("published") == "") | F.try_to_date(F.substring("published", 1, 10), "yyyy-MM-dd").isNotNull(),
        "links": F.forall(F.coalesce("patch_urls", F.array().cast("array<string>")), lambda u: u.startswith("https://")),
        "hashes": F.forall(F.coalesce("fix_shas", F.array().cast("array<string>")), lambda s: s.rlike("^[0-9a-f]{40}$")),
        "cwe": F.col("cwe").isNull() | F.col("cwe").rlike(r"^CWE-[0-9]+$") | (F.col("cwe") == "UNKNOWN"),
        "cwe_state": F.coalesce((F.col("cwe_state") == "stated") == F.col("cwe").isNotNull(), F.lit(False)),
    }
    return violations(rows, "advisory_id", rules).unionByName(duplicates(rows, "advisory_id", "unique"))


def _text(name: str) -> Column:
    return F.length(F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))) > 0


def _references(name: str) -> Column:
    """Whether an array of ids is not empty, has no blank and no repeated one."""
    ids = F.col(name)
    return ids.isNotNull() & (F.size(ids) > 0) & (F.size(F.array_distinct(ids)) == F.size(ids)) & F.forall(ids, lambda i: i.isNotNull() & (F.trim(i) != ""))


def record_violations(records: DataFrame, nodes: DataFrame, edges: DataFrame, evidence: DataFrame, claims: DataFrame) -> DataFrame:
    """Violations of an evidence pack's five tables: fields, words, unique ids, dangling edges and evidence.

    Rules about columns that a table lacks (schema_version, kind, relation, known_at, sha256, url and the like) are not asked.
    """
    keyed = lambda frame: frame.withColumn("key", F.concat_ws("/", "record_id", "id"))
    n, e, v, c = map(keyed, (nodes, edges, evidence, claims))
    ends = F.array(F.concat_ws("/", "record_id", "source"), F.concat_ws("/", "record_id", "target"))
    cited = F.transform(F.coalesce("evidence_ids", F.array().cast("array<string>")), lambda i: F.concat_ws("/", F.col("record_id"), i))

    def asked(frame: DataFrame, key: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
        """The rules (name: column, test) whose column the frame has."""
        return violations(frame, key, {name: test for name, (column, test) in rules.items() if column in frame.columns})

    https = lambda name: (name, F.col(name).startswith("https://"))
    parts = [
        asked(records, "id", {
            "title": ("title", _text("title")), "project": ("project", _text("project")), "record_id": ("id", F.col("id").rlike("^[A-Za-z0-9_.-]+$")),
            "schema_version": ("schema_version", F.col("schema_version") == "0.1.0"), "record_status": ("status", F.col("status").isin(*STATUSES)),
        }),
        asked(n, "key", {"node_kind": ("kind", F.col("kind").isin(*NODE_KINDS)), "node_label": ("label", _text("label"))}),
        asked(e, "key", {
            "edge_status": ("status", F.col("status").isin(*STATUSES)), "edge_relation": ("relation", F.col("relation").isin(*RELATIONS)),
            "edge_known_at": ("known_at", _text("known_at")), "edge_references": ("evidence_ids", _references("evidence_ids")),
        }),
        asked(c, "key", {
            "claim_status": ("status", F.col("status").isin(*STATUSES)), "claim_text": ("text", _text("text")), "claim_references": ("evidence_ids", _references("evidence_ids")),
        }),
        asked(v, "key", {
            "evidence_sha256": ("sha256", F.col("sha256").rlike("^[0-9a-f]{64}$")), "evidence_url": https("url"), "evidence_fetch_url": https("fetch_url"),
            **{f"evidence_{f}": (f, _text(f)) for f in ("observed_at", "hash_scope", "source_license", "extractor", "canonicalization")},
        }),
        duplicates(records, "id", "unique_record"),
        *(duplicates(f, "key", f"unique_{name}") for name, f in (("node", n), ("edge", e), ("evidence", v), ("claim", c))),
        *(records.join(f.select(F.col("record_id").alias("id")), "id", "left_anti").select(F.lit(f"record_{name}").alias("rule_id"), "id") for name, f in (("nodes", n), ("evidence", v))),
        dangling(e, "key", ends, n, "key", "edge_end"),
        dangling(e, "key", cited, v, "key", "edge_evidence"),
        dangling(c, "key", cited, v, "key", "claim_evidence"),
    ]
    return reduce(DataFrame.unionByName, parts)


def evolution_violations(records: DataFrame, follow_ups: DataFrame, nodes: DataFrame, edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Violations of what records say about the evolution of their fixes.

    records: (id, outcome, coverage); follow_ups: (record_id, kind, node_id, evidence_ids); nodes also (kind, attributes map).
    A follow-up must name a node and evidence of its record; a test result a passing test observation with command, revision
    and environment; one on a commit an edge from it of a supporting relation that shares evidence; a dispute a review.
    An outcome needs a follow-up of its kind.
    """
    f = follow_ups.withColumn("key", F.concat_ws("/", "record_id", "kind", "node_id"))
    node = nodes.select("record_id", F.col("id").alias("node_id"), F.col("kind").alias("_kind"), "attributes")
    relation = F.lit(None).cast("string")
    support = edges.select("record_id", F.col("source").alias("node_id"), F.col("relation").alias("_relation"), F.col("status").alias("_status"), F.col("evidence_ids").alias("_cited"))
    with_node = f.join(node, ["record_id", "node_id"], "left")
    allowed = relation
    for kind, names in SUPPORTING.items():
        firm = F.lit(True) if kind == "path_followup" else F.col("_status").isin("observed", "validated")
        allowed = F.when((F.col("kind") == kind), F.when(F.col("_relation").isin(*names) & firm & F.arrays_overlap("_cited", "evidence_ids"), "yes")).otherwise(allowed)
    supported = f.join(support, ["record_id", "node_id"]).where(allowed == "yes").select("key").distinct().withColumn("_supported", F.lit(True))
    passing = (F.col("_kind") == "test_observation") & (F.col("attributes")["outcome"] == "PASS") & F.forall(
        F.array(*(F.lit(k) for k in ("command", "revision", "environment"))), lambda k: F.coalesce(F.trim(F.element_at("attributes", k)), F.lit("")) != ""
    )
    on_commit = F.col("kind").isin(*SUPPORTING)
    good = (
        F.when(F.col("kind") == "test_result", passing)
        .when(on_commit, (F.col("_kind") == "commit") & F.coalesce("_supported", F.lit(False)))
        .otherwise(F.col("_kind") == "review_observation")
    )
    judged = with_node.join(supported, "key", "left")
    cited = F.transform(F.coalesce("evidence_ids", F.array().cast("array<string>")), lambda i: F.concat_ws("/", F.col("record_id"), i))
    need = F.lit(None).cast("string")
    for outcome, kind in NEEDED.items():
        need = F.when(F.col("outcome") == outcome, kind).otherwise(need)
    have = follow_ups.groupBy(F.col("record_id").alias("id")).agg(F.collect_set("kind").alias("_kinds"))
    kinds = F.coalesce("_kinds", F.array().cast("array<string>"))
    parts = [
        violations(judged, "key", {
            "followup_kind": F.col("kind").isin(*FOLLOW_UPS), "followup_node": F.col("_kind").isNotNull(), "followup_references": _references("evidence_ids"), "followup_support": good,
        }),
        dangling(f, "key", cited, evidence.withColumn("key", F.concat_ws("/", "record_id", "id")), "key", "followup_evidence"),
        violations(records.withColumn("_need", need).join(have, "id", "left"), "id", {
            "outcome": F.col("outcome").isin(*OUTCOMES), "evolution_coverage": _text("coverage"), "outcome_support": F.col("_need").isNull() | F.array_contains(kinds, F.col("_need")),
        }),
    ]
    return reduce(DataFrame.unionByName, parts)


def slice_violations(rows: DataFrame, project: str, hosts: tuple[str, ...], start: str, end: str) -> DataFrame:
    """Violations of a project's study slice (advisory_id, project, published, coverage, fix_sha, fix_url): the project itself, a
    publication inside [start, end], a stated coverage, a full fix hash, and a fix URL of an allowed host that names the hash."""
    host = F.regexp_extract(F.lower("fix_url"), "^https://([^/?#:]+)", 1)
    own = F.lit(False)
    for name in hosts:
        own = own | (host == name) | host.endswith("." + name)
    rules = {
        "slice_id": F.col("advisory_id").rlike(r"^[A-Z][A-Z0-9]*-[A-Za-z0-9-]+$"),
        "slice_project": F.col("project") == project,
        "slice_window": F.substring("published", 1, 10).between(start, end),
        "slice_coverage": F.col("coverage").isin(*COVERAGES),
        "slice_fix": F.col("fix_sha").rlike("^[0-9a-f]{40}$"),
        "slice_host": own,
        "slice_url": F.contains(F.lower("fix_url"), F.col("fix_sha")),
    }
    return violations(rows, "advisory_id", rules).unionByName(duplicates(rows, "advisory_id", "slice_unique"))


def fragment_violations(fragments: DataFrame) -> DataFrame:
    """Violations of fragments (record_id, coverage, start, stop, body_sha256)."""
    return violations(fragments, "record_id", {
        "coverage": F.col("coverage").isin(*COVERAGES),
        "range": (F.col("start") >= 1) & (F.col("stop") >= F.col("start")),
        "body": F.col("body_sha256").isNull() | F.col("body_sha256").rlike("^[0-9a-f]{64}$"),
    })


def receipt_violations(receipts: DataFrame) -> DataFrame:
    """Violations of publication receipts (namespace, id, digest)."""
    return violations(receipts, "id", {
        "namespace": F.col("namespace").rlike("^[a-z][a-z0-9_-]{0,62}$"),
        "digest": F.col("digest").rlike("^[0-9a-f]{64}$"),
        "path": ~F.col("id").rlike(r"\.\.|^/|\\"),
    })


# The fields of an enrolment, and what they look like.
REQUIRED, OPTIONAL = ("repo", "primary_contact"), ("auto_ccs", "homepage", "pgp", "disabled", "dockerfile", "threat_model")
HTTPS_URL = r"^https://[^\s#]+(#[A-Za-z0-9._/-]{1,100})?$"
ADDRESS = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
INNER_PATH = r"^(?!/)(?!.*\.\.)[A-Za-z0-9._/-]+$"


def enrolment_problems(rows: DataFrame) -> DataFrame:
    """rows with problems, an array of what is wrong with each enrolment; empty if nothing is.

    rows: name, keys (array of the fields that are given), repo, primary_contact, auto_ccs (array), homepage, dockerfile, threat_model,
    and has_dockerfile (whether one lies beside it). A bad name is the only problem that is told of its row.
    """
    none = F.array().cast("array<string>")
    given = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    fits = lambda c, pattern: F.col(c).isNull() | F.col(c).rlike(pattern)
    unknown = F.transform(F.array_except(F.coalesce("keys", none), F.array(*(F.lit(k) for k in REQUIRED + OPTIONAL))), lambda k: F.concat(F.lit("unknown field "), k))
    people = F.concat(F.when(given("primary_contact"), F.array("primary_contact")).otherwise(none), F.coalesce("auto_ccs", none))
    bad = F.transform(F.filter(people, lambda a: ~a.rlike(ADDRESS)), lambda a: F.concat(F.lit("bad email "), a))
    beside = F.coalesce("has_dockerfile", F.lit(False))
    single = F.array_compact(F.array(
        *(F.when(~given(k), f"missing {k}") for k in REQUIRED),
        F.when(~fits("repo", HTTPS_URL), "repo is no https URL"), F.when(~fits("homepage", r"^https://[^\s#]+(#.*)?$"), "homepage is no https URL"),
        *(F.when(~fits(k, INNER_PATH), f"{k} is no path inside the repository") for k in ("dockerfile", "threat_model")),
        F.when(~beside & F.col("dockerfile").isNull(), "a Dockerfile is required"), F.when(beside & F.col("dockerfile").isNotNull(), "a Dockerfile is given twice"),
    ))
    every = F.concat(unknown, single, bad)
    good = F.coalesce(F.col("name").rlike("^[a-z0-9][a-z0-9._-]{0,62}$"), F.lit(False))
    return rows.withColumn("problems", F.when(good, every).otherwise(F.array(F.lit("bad name"))))
