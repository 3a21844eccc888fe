"""Lock files to dependencies, and dependencies to advisories."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import first_fixed, package_name, version_key
from corvane.operators.merging import alias_components
from corvane.session import checkpointed

DEPENDENCY = "path string, ordinal int, ecosystem string, name string, version string"


# What a pinned requirement and a module line of a go.sum look like.
PINNED = re.compile(r"([A-Za-z0-9][A-Za-z0-9._-]*)(?:\[[^\]]*\])?\s*==\s*([0-9][A-Za-z0-9.!+*_]*)")
GO_LINE = re.compile(r"(\S+)\s+(\S+)\s+h1:")


def _requirements(text: str) -> list[tuple[str, str, str]]:
    """Exact pins only: options, environment markers and other operators make a line none."""
    lines = (line.strip().split(" #", 1)[0].strip() for line in text.splitlines())
    pins = (PINNED.fullmatch(line) for line in lines if line[:1] not in ("", "#", "-"))
    return [("PyPI", re.sub(r"[-_.]+", "-", pin[1]).lower(), pin[2]) for pin in pins if pin]


def _unquoted(value: str) -> str:
    return re.sub(r'\\(["\\])', r"\1", value[1:-1]) if len(value) > 1 and value[0] == value[-1] == '"' else value


def _cargo(text: str) -> list[tuple[str, str, str]]:
    """`[[package]]` tables from a registry; those of the oldest format name no source."""
    out: list[tuple[str, str, str]] = []
    table: dict[str, str] | None = None
    for line in [*map(str.strip, text.splitlines()), "[end]"]:
        if line.startswith("["):
            if table and table.get("name") and table.get("version") and table.get("source", "registry+").startswith("registry+"):
                out.append(("crates.io", table["name"], table["version"]))
            table = {} if re.match(r"\[\[\s*package\s*\]\]", line) else None
        elif table is not None and not line.startswith("#") and "=" in line:
            key, value = (x.strip() for x in line.split("=", 1))
            table[key] = _unquoted(value)
    return out


def _npm(text: str) -> list[tuple[str, str, str]]:
    """`packages` of newer files, workspace folders included and links left out; else nested `dependencies`, inner ones first."""
    try:
        data = json.loads(text)
    except ValueError:
        return []
    if not isinstance(data, dict):
        return []
    places = data.get("packages")
    if isinstance(places, dict):
        real = ((p, e) for p, e in places.items() if p and isinstance(e, dict) and not e.get("link") and e.get("version"))
        return [("npm", str(e.get("name") or p.rpartition("node_modules/")[2]), str(e["version"])) for p, e in real]
    out: list[tuple[str, str, str]] = []

    def nested(entries: dict) -> None:
        for name in sorted(entries):
            entry = entries[name]
            if isinstance(entry, dict):
                if isinstance(entry.get("dependencies"), dict):
                    nested(entry["dependencies"])
                if entry.get("version"):
                    out.append(("npm", str(name), str(entry["version"])))

    nested(data.get("dependencies") or {})
    return out


def _package_key(line: str) -> tuple[str, str] | None:
    """(name, version) of a line `name@version:`, scoped or not, quoted or not, without peers in parentheses."""
    key = line.strip().removesuffix(":").strip().strip("'\"").split("(", 1)[0].strip()
    name, at, version = key[1:].partition("@") if key.startswith("@") else key.partition("@")
    name = key[: len(key) - len(at) - len(version)] if at else ""
    return (name, version) if name and version else None


def _pnpm(text: str) -> list[tuple[str, str, str]]:
    """Keys of the `packages:` section, all at one depth, which older files have at column 0; deeper lines belong to a key."""
    out: list[tuple[str, str, str]] = []
    inside, depth = False, None
    for line in text.splitlines():
        bare = line.strip()
        if not bare.endswith(":") or bare.startswith("#"):
            continue
        indent, key = len(line) - len(line.lstrip(" ")), _package_key(bare)
        if not inside:
            inside, depth = (True, None) if indent == 0 and bare[:-1].strip().strip("'\"") == "packages" else (False, None)
            continue
        if depth is not None and indent > depth:
            continue
        if key is None or (depth is not None and indent < depth and indent > 0):
            inside, depth = False, None
            continue
        if depth is not None and indent < depth:  # a key further out begins a section of its own depth
            depth = indent
            continue
        depth = indent
        out.append(("npm", *key))
    return out


def _go_sum(text: str) -> list[tuple[str, str, str]]:
    """Module lines; those of go.mod files are none. Versions keep their v."""
    lines = (GO_LINE.match(line.strip()) for line in text.splitlines() if not line.strip().startswith("#"))
    return [("Go", line[1], line[2].removesuffix("+incompatible")) for line in lines if line and not line[2].endswith("/go.mod")]


def parser(path: str):
    """The parser for a lock file's name, else None."""
    name = path.rsplit("/", 1)[-1]
    known = {"Cargo.lock": _cargo, "package-lock.json": _npm, "pnpm-lock.yaml": _pnpm, "go.sum": _go_sum}
    if name in known:
        return known[name]
    return _requirements if re.fullmatch(r"requirements[^/]*\.txt", name) else None


def parse(lockfiles: DataFrame) -> DataFrame:
    """(path, ordinal, ecosystem, name, version): distinct pinned dependencies, in file order.

    lockfiles: (path, text). The formats nest and recurse, so this is a map over files; unknown
    names and broken files give none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, text in batch[["path", "text"]].itertuples(index=False):
                read = parser(path or "")
                found = list(dict.fromkeys(read(text or ""))) if read else []
                rows += [(path, k, *d) for k, d in enumerate(found)]
            yield pd.DataFrame(rows, columns=["path", "ordinal", "ecosystem", "name", "version"]).astype({"ordinal": "int32"})

    return lockfiles.select("path", "text").mapInPandas(run, DEPENDENCY)


def affected_entries(affected: Column, name: Column, ecosystem: Column) -> Column:
    """The entries of an advisory for a package; an entry without ecosystem fits any."""
    return F.filter(
        affected,
        lambda a: (a["package"]["name"] == name) & ((F.coalesce(a["package"]["ecosystem"], F.lit("")) == "") | (a["package"]["ecosystem"] == ecosystem)),
    )


def fixed_versions(entries: Column) -> Column:
    """Distinct versions of all `fixed` events."""
    events = F.flatten(F.flatten(F.transform(entries, lambda a: F.transform(a["ranges"], lambda r: r["events"]))))
    return F.array_distinct(F.filter(F.transform(events, lambda e: e["fixed"]), lambda v: v.isNotNull()))


def severity(advisory_scores: Column, database: Column) -> Column:
    """The first score, else what the database says."""
    return F.coalesce(F.get(F.filter(F.transform(advisory_scores, lambda s: s["score"]), lambda x: x.isNotNull()), F.lit(0)), database)


def offers(packages: DataFrame, advisories: DataFrame) -> DataFrame:
    """packages (ecosystem, name, ...) with each advisory that names them: id, aliases, fixed, severity. Which do, no version decides."""
    offered = advisories.select("*", F.explode(F.array_distinct(F.transform("affected", lambda a: a["package"]["name"]))).alias("name"))
    return (
        packages.join(offered, "name")
        .withColumn("entries", affected_entries(F.col("affected"), F.col("name"), F.col("ecosystem")))
        .where(F.size("entries") > 0)
        .select(*packages.columns, "id", "aliases", fixed_versions(F.col("entries")).alias("fixed"), severity(F.col("severity"), F.col("database_severity")).alias("severity"))
    )


def findings(dependencies: DataFrame, advisories: DataFrame) -> DataFrame:
    """(path, ecosystem, name, version, id, aliases, fixed, fix, severity) sorted by file, package, id.

    Distinct (ecosystem, name, version) are matched once and expanded to the files afterwards.
    advisories: (id, aliases, affected, severity, database_severity).
    """
    matched = offers(dependencies.select("ecosystem", "name", "version").distinct(), advisories)
    matched = matched.withColumn("fix", F.when(F.size("fixed") > 0, first_fixed(F.col("version"), F.col("fixed"))))
    return dependencies.join(matched, ["ecosystem", "name", "version"]).select(
        "path", "ecosystem", "name", "version", "id", "aliases", "fixed", "fix", "severity"
    ).orderBy("path", F.lower("name"), "id")


# Which of several ids of one vulnerability names it.
ID_RANK = ("RUSTSEC-", "GHSA-", "PYSEC-", "GO-", "CVE-")


def _keyed(fixed: Column) -> Column:
    return F.array_sort(F.transform(fixed, lambda v: F.struct(version_key(v).alias("key"), v.alias("v"))))


def _with_fix(folded: DataFrame) -> DataFrame:
    """Rows with `keyed`, the fixed versions in order, and `installed`, the key of the version, in the form of `vulnerabilities`."""
    above = F.filter("keyed", lambda x: x["key"] > F.col("installed"))
    return folded.select(
        *(c for c in folded.columns if c not in ("keyed", "installed", "primary", "aliases", "fixed", "severity")),
        F.col("primary").alias("id"), "aliases", F.transform("keyed", lambda x: x["v"]).alias("fixed"), F.get(above, F.lit(0))["v"].alias("fix"), "severity",
    )


def vulnerabilities(found: DataFrame) -> DataFrame:
    """`findings` with the ids that alias each other folded: one row per dependency of a file and vulnerability.

    Fixed versions of all its ids ascend; fix is the first above the installed one, null if none is.
    """
    folded = alias_components(found, ["path", "ecosystem", "name", "version"], ID_RANK, own=True)
    return _with_fix(folded.withColumns({"keyed": _keyed(F.col("fixed")), "installed": version_key(F.col("version"))})).orderBy("path", F.lower("name"), "id")


def package_vulnerabilities(dependencies: DataFrame, advisories: DataFrame) -> DataFrame:
    """`vulnerabilities` of the `findings`, folded before any version or file multiplies them.

    An advisory names packages, so its ids fold alike for all versions and files: once per package. What is
    fixed is then looked up once per version, and the files come last.
    """
    dependencies = checkpointed(dependencies.select("path", "ecosystem", "name", "version").distinct())
    packages = offers(dependencies.select("ecosystem", "name").distinct(), advisories)
    folded = alias_components(packages, ["ecosystem", "name"], ID_RANK, own=True).withColumn("keyed", _keyed(F.col("fixed")))
    versions = dependencies.select("ecosystem", "name", "version").distinct().withColumn("installed", version_key(F.col("version")))
    matched = _with_fix(versions.join(checkpointed(folded), ["ecosystem", "name"]))
    return dependencies.join(matched, ["ecosystem", "name", "version"]).select(
        "path", "ecosystem", "name", "version", "id", "aliases", "fixed", "fix", "severity"
    ).orderBy("path", F.lower("name"), "id")


def normal_names(frame: DataFrame, column: str = "name") -> DataFrame:
    return frame.withColumn(column, package_name(F.col(column)))
