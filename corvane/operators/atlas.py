"""The atlas: details joined to entries, names of classes, summaries of overlays and catalogs, conversions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.advisories import SHA40
from corvane.operators.rollups import first_reason


def fragment_shape(files: Column) -> Column:
    """Files of a fragment with all their fields, defaults where one is null.

    files: array of (path, status, language, before_blob_sha, after_blob_sha, functions array of (name, before_range,
    after_range, lines_added, lines_removed)).
    """
    word = lambda x, name, default="": F.coalesce(x[name], F.lit(default)).alias(name)
    span = lambda x, name: F.coalesce(x[name], F.array(F.lit(0), F.lit(0))).alias(name)
    number = lambda x, name: F.coalesce(x[name], F.lit(0)).alias(name)
    function = lambda f: F.struct(span(f, "after_range"), span(f, "before_range"), number(f, "lines_added"), number(f, "lines_removed"), word(f, "name"))
    return F.transform(
        F.coalesce(files, F.array()),
        lambda x: F.struct(
            word(x, "after_blob_sha"), word(x, "before_blob_sha"), F.transform(F.coalesce(x["functions"], F.array()), function).alias("functions"),
            word(x, "language"), word(x, "path"), word(x, "status", "modified"),
        ),
    )


def fingerprint_shape(files: Column) -> Column:
    """The functions of a fingerprint's files (path, functions) in one array, with the path of each.

    functions: array of (name, before, after, added_calls, removed_calls, added_guards); before and after have
    start_line and end_line, and become ranges, null where the function is missing on that side.
    """
    none = F.array().cast("array<string>")
    span = lambda side: F.when(side.isNotNull(), F.array(side["start_line"], side["end_line"]))

    def functions(file: Column) -> Column:
        return F.transform(
            F.coalesce(file["functions"], F.array()),
            lambda f: F.struct(
                F.coalesce(f["added_calls"], none).alias("added_calls"), f["added_guards"].alias("added_guards"), span(f["after"]).alias("after_range"),
                span(f["before"]).alias("before_range"), F.coalesce(f["name"], F.lit("")).alias("name"), F.coalesce(file["path"], F.lit("")).alias("path"),
                F.coalesce(f["removed_calls"], none).alias("removed_calls"),
            ),
        )

    return F.flatten(F.transform(F.coalesce(files, F.array()), functions))


def with_details(entries: DataFrame, fragments: DataFrame, fingerprints: DataFrame, keys: tuple[str, ...] = ("project", "id")) -> DataFrame:
    """Entries with their fragment and fingerprint (null if there is none) and has_fix, has_fragments, has_fingerprint.

    The others have one row per key, with a column fragment or fingerprint; entries have fix_shas.
    """
    joined = entries.join(fragments.select(*keys, "fragment"), list(keys), "left").join(fingerprints.select(*keys, "fingerprint"), list(keys), "left")
    return joined.withColumns({
        "has_fix": F.coalesce(F.size("fix_shas") > 0, F.lit(False)),
        "has_fragments": F.col("fragment").isNotNull(),
        "has_fingerprint": F.col("fingerprint").isNotNull(),
    })


def with_class_names(frame: DataFrame, curated: DataFrame, official: DataFrame, unknown: str = "Unstated or Legacy Advisory Without CWE Classification") -> DataFrame:
    """frame with the title of its cwe: the official name, else the curated title, else the id; for UNKNOWN the curated one or `unknown`.

    curated and official: (cwe, title), one row per class.
    """
    names = frame.join(official.select("cwe", F.col("title").alias("_official")), "cwe", "left").join(curated.select("cwe", F.nullif("title", F.lit("")).alias("_curated")), "cwe", "left")
    default = F.when(F.col("cwe") == "UNKNOWN", unknown).otherwise(F.col("cwe"))
    return names.withColumn("title", F.coalesce("_official", "_curated", default)).drop("_official", "_curated")


# What flaws of some classes presuppose.
PRECONDITIONS = {
    "Untrusted buffer length or unbounded string processing": ("CWE-119", "CWE-120", "CWE-125", "CWE-787"),
    "Asynchronous lifecycle, double free, or aliased pointer reuse": ("CWE-416",),
    "Unchecked return value from allocator or lookup function": ("CWE-476",),
    "Multithreaded / interrupt context without adequate lock barrier": ("CWE-362",),
    "Missing boundary / sanitize check on incoming payload": ("CWE-20", "CWE-200"),
    "Resource exhaustion path without rate limit or quota": ("CWE-399", "CWE-400", "CWE-401"),
}


def preconditions(cwe: Column) -> Column:
    """Array of what a class presupposes; empty for others."""
    stated = F.array(*(F.when(cwe.isin(*classes), text) for text, classes in PRECONDITIONS.items()))
    return F.array_compact(stated)


def provenance_summary(rows: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """(source, n): rows by where their class is from: catalog, each of the overlay's sources (0 included), and unknown.

    rows: (cwe, cwe_source), the source null where the class is the catalog's own or missing.
    """
    stated = F.coalesce(F.trim("cwe") != "", F.lit(False))
    sums = rows.agg(
        F.count_if(stated & (F.coalesce("cwe_source", F.lit("catalog")) == "catalog")).alias("catalog"),
        *(F.count_if(stated & (F.col("cwe_source") == s)).alias(f"s{k}") for k, s in enumerate(sources)),
        F.count_if(~stated).alias("unknown"),
    )
    names = ["catalog", *sources, "unknown"]
    columns = ["catalog", *(f"s{k}" for k in range(len(sources))), "unknown"]
    return sums.select(F.inline(F.array(*(F.struct(F.lit(n).alias("source"), F.col(c).alias("n")) for n, c in zip(names, columns, strict=True)))))


def overlay_summary(targets: DataFrame, overlay: DataFrame, project: str = "linux-cna") -> DataFrame:
    """One row: overlay_rows and the unknown ids before and after the overlay, in all and of one project.

    targets: (advisory_id, cwe, projects), one row per id; overlay: (advisory_id), one row per id that it resolves.
    """
    unknown = F.coalesce(F.col("cwe"), F.lit("")) == ""
    own = F.coalesce(F.array_contains("projects", project), F.lit(False))
    marked = targets.join(overlay.select("advisory_id", F.lit(True).alias("_resolved")), "advisory_id", "full_outer")
    resolved = F.coalesce("_resolved", F.lit(False))
    return marked.agg(
        F.count_if(resolved).alias("overlay_rows"),
        F.count_if(unknown & F.col("projects").isNotNull()).alias("before_total"),
        (F.count_if(unknown & F.col("projects").isNotNull()) - F.count_if(resolved)).alias("after_total"),
        F.count_if(unknown & own).alias("before_project"),
        (F.count_if(unknown & own) - F.count_if(resolved & own)).alias("after_project"),
    )


# What a catalog can be like.
CATALOG_STATES = ("CURSOR_PAUSED", "NOT_FETCHED", "OBSERVED_EMPTY", "COMPLETE", "SNAPSHOT_COMPLETE")


def manifest_rollup(catalogs: DataFrame) -> DataFrame:
    """One row: project_count, totals of entries, with_fix_sha and requests, and a map of the states' counts, 0 included.

    catalogs: (project, status, entries, with_fix_sha, requests), one row per catalog.
    """
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(f"total_{name}")
    states = F.create_map(*(x for s in CATALOG_STATES for x in (F.lit(s), F.count_if(F.col("status") == s))))
    return catalogs.agg(F.count("*").alias("project_count"), *map(total, ("entries", "with_fix_sha", "requests")), states.alias("states"))


def catalogs_of(projects: DataFrame, catalogs: DataFrame) -> DataFrame:
    """(name, catalogs): catalogs by the last part of a project's repository or its name, with or without `-upstream`.

    projects: (name, repository); catalogs: (catalog). All in lower case; sorted, empty if there is none.
    """
    base = F.lower(F.element_at(F.split(F.coalesce("repository", F.lit("")), "/"), -1))
    wanted = projects.select("name", F.explode(F.array_distinct(F.array(base, F.lower("name")))).alias("_key"))
    known = catalogs.select("catalog", F.regexp_replace(F.lower("catalog"), "-upstream$", "").alias("_key"))
    hits = wanted.join(known, "_key", "left").groupBy("name")
    return hits.agg(F.array_sort(F.collect_set("catalog")).alias("catalogs"))


def first_present(alternatives: DataFrame, present: DataFrame) -> DataFrame:
    """(project, catalog): of the alternatives (project, ord, catalog) of each project the first that is present (catalog)."""
    return alternatives.join(present.select("catalog").distinct(), "catalog", "left_semi").groupBy("project").agg(F.min_by("catalog", "ord").alias("catalog"))


def year_span(ids: Column) -> Column:
    """Aggregate: first and last year of CVE ids as `2001-2004`, or none."""
    year = F.regexp_extract(ids, "^CVE-([0-9]{4})-", 1)
    known = F.when(year != "", year.try_cast("int"))
    return F.coalesce(F.concat(F.min(known).cast("string"), F.lit("-"), F.max(known).cast("string")), F.lit("none"))


def ordered_histogram(frame: DataFrame, column: str) -> DataFrame:
    """(value, n), the most frequent first, ties by name."""
    return frame.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value")


def converted(rows: DataFrame, stating: tuple[str, ...], digested: tuple[str, ...]) -> DataFrame:
    """Vetted rows as records or with the first reason why not: reason is null for those that convert.

    rows: project, advisory_id, fix_sha, fix_url, digest, evidence_url, observed_at, family, cwe, cwe_state. Converted rows
    have record_id, slug (of the repository), cwe_state and claim_status: a class of a project that states none itself counts
    as assigned by the study, and its claim as a hypothesis. digested: projects of which the origin of digests is declared.
    """
    text = lambda name: F.coalesce(F.trim(F.col(name)) != "", F.lit(False))
    url = r"^https://github\.com/([^/]+)/([^/]+)/(?:commit|blob)/([0-9a-f]{40})"
    reason = first_reason([
        ("missing project", text("project")), ("missing advisory_id", text("advisory_id")),
        ("no valid 40-hex fix SHA", F.col("fix_sha").rlike(SHA40)), ("no https fix URL", F.col("fix_url").startswith("https://")),
        ("fix URL is not a recognized GitHub commit/blob reference", F.col("fix_url").rlike(url)),
        ("fix SHA and fix URL disagree", F.regexp_extract("fix_url", url, 3) == F.col("fix_sha")),
        ("no declared digest provenance", F.col("project").isin(*digested)),
        ("source digest is not a sha256", F.col("digest").rlike("^[0-9a-f]{64}$")),
        ("source evidence URL is missing or not https", F.col("evidence_url").startswith("https://")),
        ("source observed_at is missing", text("observed_at")), ("source record has no pattern family", text("family")),
    ])
    cwe = F.when(text("cwe"), F.col("cwe"))
    state = F.when(cwe.isNotNull() & ~F.col("project").isin(*stating), "ASSIGNED_BY_STUDY").otherwise(F.when(text("cwe_state"), F.col("cwe_state")).otherwise("UNKNOWN"))
    judged = rows.withColumn("reason", reason).withColumn("cwe_state", state)
    good = F.col("reason").isNull()
    slug = F.concat_ws("/", F.regexp_extract("fix_url", url, 1), F.regexp_extract("fix_url", url, 2))
    return judged.withColumns({
        "record_id": F.when(good, F.concat_ws("-", "project", "advisory_id")),
        "slug": F.when(good, slug),
        "claim_status": F.when(good, F.when(F.col("cwe_state") == "ASSIGNED_BY_STUDY", "hypothesis").otherwise("observed")),
    })
