"""Scalars of advisory records: classes, owners, subsystems, fix references, templates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import family

# Spellings and sentinels of the feeds.
CWE = "^CWE-[0-9]+$"
SENTINELS = ("NVD-CWE-noinfo", "NVD-CWE-Other")
SHA40 = "^[0-9a-f]{40}$"
GUARDS = {
    "cve": r"^CVE-[0-9]{4}-[0-9]{4,}$",
    "cwe": CWE,
    "sha": SHA40,
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "project": r"^[a-z0-9][a-z0-9._-]*$",
}

# Words in an advisory's configurations that name a project, and (part of a host, words) of
# references that do; the words are looked for in host and path, no words mean that the host is enough.
OWNERS: dict[str, tuple[tuple[str, ...], tuple[tuple[str, tuple[str, ...]], ...]]] = {
    "curl": (("curl",), (("curl.se", ()), ("haxx.se", ()), ("github.com", ("curl",)))),
    "git": (
        ("git:git", "git_project", "git-scm"),
        (("github.com", ("git/git",)), ("git-scm.com", ()), ("git.kernel.org", ("git/git",)), ("lore.kernel.org", ("/git",))),
    ),
    "glibc": (("glibc", "gnu_c_library"), (("sourceware.org", ("libc",)), ("gnu.org", ("libc",)), ("github.com", ("glibc",)))),
    "nginx": (
        ("nginx",),
        (("nginx.org", ()), ("nginx.net", ()), ("nginx.com", ()), ("sysoev.ru", ("nginx",)), ("github.com", ("nginx",))),
    ),
    "openssh": (("openssh",), (("openssh.com", ()), ("mindrot.org", ()), ("github.com", ("openssh",)), ("openbsd.org", ("openssh",)))),
    "openssl": (("openssl",), (("openssl.org", ()), ("github.com", ("openssl",)))),
    "postgresql": (("postgres",), (("postgresql.org", ()), ("github.com", ("postgres",)))),
    "qemu": (("qemu",), (("gitlab.com", ("qemu",)), ("github.com", ("qemu",)), ("qemu.org", ()), ("qemu-project.org", ()))),
    "sqlite": (("sqlite",), (("sqlite.org", ()), ("github.com", ("sqlite",)))),
    "systemd": (("systemd",), (("github.com", ("systemd",)), ("freedesktop.org", ("systemd",)), ("systemd.io", ()))),
    "unbound": (("unbound",), (("github.com", ("unbound", "nlnetlabs")), ("nlnetlabs.nl", ("unbound",)), ("unbound.net", ()))),
}
#: Hosts of which the query of a reference counts too.
WHOLE_URL = ("git.kernel.org", "sourceware.org", "sysoev.ru", "openbsd.org", "freedesktop.org", "nlnetlabs.nl")


# Words of descriptions by the family that they tell, in the order in which they are tried, and what is left.
FAMILIES: dict[str, tuple[tuple[tuple[str, str], ...], str]] = {
    "sqlite": (
        (
            ("memory-lifetime", "use-after-free|double free|lifetime|dangling"), ("bounds", "out-of-bounds|buffer overflow|over-read|bounds"),
            ("integer", "integer overflow|underflow|wrap"), ("concurrency", "race condition|lock|concurrency|thread"),
            ("authz", "permission|auth|privilege|access control"), ("injection", "injection"), ("crypto", "crypto|cipher|digest|tls|key"),
            ("path-resolution", "path traversal|directory traversal|symlink"), ("parser", "parser|syntax|malformed|unexpected token"),
            ("resource-accounting", "resource exhaustion|memory leak|denial of service|dos|infinite loop"), ("logic", "logic|mishandle|miscalculation|incorrect"),
        ),
        "unknown",
    ),
    "systemd": (
        (
            ("memory-lifetime", "use-after-free|double free|lifetime|dangling|memory leak|refcount"), ("bounds", "out-of-bounds|buffer overflow|oob|bounds|underflow|overread"),
            ("integer", "integer overflow|integer underflow|wraparound"), ("concurrency", "race condition|data race|concurrency|lock"),
            ("authz", "polkit|privilege|authz|permission|authorization|unauthorized"), ("injection", "injection"), ("crypto", "crypto|tls|certificate|key"),
            ("path-resolution", "path traversal|symlink|directory traversal|path-resolution"), ("parser", "parser|parsing|format string"),
            ("resource-accounting", "denial of service|dos|resource|exhaustion|memory consumption"), ("logic", "logic|validation|incorrect|improper"),
        ),
        "unknown",
    ),
    "qemu": (
        (
            ("memory-lifetime", "use-after-free|double free|freeing|virtqueue elements"), ("bounds", "out-of-bounds|buffer overflow|overrun"),
            ("integer", "underflow|division by zero"), ("bounds", "integer"), ("concurrency", "reentrancy|dma|race|concurrent"),
            ("authz", "installer|elevation|privilege|unprivileged"), ("path-resolution", "traversal|directory|path"),
        ),
        "logic",
    ),
    "glibc": (
        (
            ("authz", "ld_library_path|setuid|environment variable", ("CWE-426",)),
            ("bounds", None, ("CWE-120", "CWE-121", "CWE-122", "CWE-125", "CWE-787")),
            ("integer", "integer overflow|wraparound", ("CWE-190",)),
            ("memory-lifetime", "use-after-free|double free", ("CWE-416", "CWE-415")),
            ("concurrency", "race condition|concurrency|deadlock"),
            ("bounds", "out-of-bounds|buffer overflow|bounds check"),
            ("parser", "parser|format string"),
        ),
        "logic",
    ),
}
# Advisories whose family a project states itself.
KNOWN_FAMILIES = {
    "qemu": {
        "CVE-2022-26354": "memory-lifetime",
        "CVE-2023-40360": "logic",
        "CVE-2023-42467": "integer",
        "CVE-2023-0664": "authz",
        "CVE-2022-35414": "logic",
        "CVE-2022-2962": "concurrency",
        "CVE-2022-26353": "memory-lifetime",
        "CVE-2024-24474": "bounds",
    },
}


def pattern_family(project: str, text: Column, classes: Column | None = None, identifier: Column | None = None) -> Column:
    """The family that a project gives to an advisory: the one that it states for the identifier, else that of the first of its
    rules of which a word occurs in the description, whatever its case, or a class is among the stated ones (an array)."""
    rules, default = FAMILIES[project]
    lower = F.lower(F.coalesce(text, F.lit("")))
    stated = F.coalesce(classes, F.array().cast("array<string>")) if classes is not None else F.array().cast("array<string>")
    found = F.lit(default)
    for name, words, *own in reversed(rules):
        met = lower.rlike(words) if words else F.lit(False)
        if own:
            met = met | F.arrays_overlap(stated, F.array(*map(F.lit, own[0])))
        found = F.when(F.coalesce(met, F.lit(False)), name).otherwise(found)
    if identifier is not None:
        for name, known in KNOWN_FAMILIES.get(project, {}).items():
            found = F.when(identifier == name, known).otherwise(found)
    return found


def guarded(column: Column, kind: str) -> Column:
    """Whether a value is well formed: kind cve, cwe, sha, date or project. Null is not."""
    return F.coalesce(column.rlike(GUARDS[kind]) & ~column.endswith("\n"), F.lit(False))


def owned_by(project: str, configurations: Column, references: Column) -> Column:
    """Whether an advisory is a project's own: its configurations (JSON text) name it, or one of its references (URLs) does."""
    words, hosts = OWNERS[project]
    config = F.lower(F.coalesce(configurations, F.lit("")))
    named = reduce(lambda a, w: a | F.contains(config, F.lit(w)), words, F.lit(False))

    def refers(url: Column) -> Column:
        host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
        place = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^?#]*)", 1)
        found = F.lit(False)
        for part, names in hosts:
            on_host = F.contains(host, F.lit(part))
            # a host holds its own name: words count behind it, or in front of it for hosts of others
            rest = F.replace(F.lower(url) if part in WHOLE_URL else place, F.lit(part), F.lit(""))
            found = found | (on_host & reduce(lambda a, w, r=rest: a | F.contains(r, F.lit(w)), names, F.lit(not names)))
        return found

    return named | F.exists(F.coalesce(references, F.array().cast("array<string>")), refers)


def _values(weaknesses: Column, kind: str | None) -> Column:
    """Values of all descriptions of weaknesses (type, description array of (value)), of one type if given."""
    kept = F.filter(weaknesses, lambda w: w["type"] == kind) if kind else weaknesses
    return F.flatten(F.transform(kept, lambda w: F.transform(F.coalesce(w["description"], F.array()), lambda d: d["value"])))


def first_cwe(weaknesses: Column) -> Column:
    """struct(cwe, state) of the first class that a description names, in capitals; state UNKNOWN if none does."""
    none = F.array().cast("array<string>")
    found = F.get(F.filter(F.coalesce(_values(weaknesses, None), none), lambda v: v.rlike("(?i)^CWE-[0-9]+$")), F.lit(0))
    return F.struct(F.upper(found).alias("cwe"), F.when(found.isNull(), "UNKNOWN").otherwise("STATED_BY_ADVISORY").alias("state"))


def cwe_lists(weaknesses: Column) -> Column:
    """struct(primary, secondary, sentinels, distinct): classes by the type of their weakness, in order and once each,
    the number of values that say there is none, and the ordered union."""
    none = F.array().cast("array<string>")

    def real(kind: str) -> Column:
        cleaned = F.transform(F.coalesce(_values(weaknesses, kind), none), lambda v: F.upper(F.trim(v)))
        return F.array_distinct(F.filter(cleaned, lambda v: v.rlike(CWE)))

    primary, secondary = real("Primary"), real("Secondary")
    sentinels = F.size(F.filter(F.coalesce(_values(weaknesses, None), none), lambda v: v.isin(*SENTINELS)))
    return F.struct(primary.alias("primary"), secondary.alias("secondary"), sentinels.alias("sentinels"), F.array_union(primary, secondary).alias("distinct"))


def adp_cwes(record_id: Column, wanted: Column, containers: Column) -> Column:
    """Classes of the problem types in a record's ADP containers, in order and once each; null if the record is of another id.

    containers: array of (problemTypes array of (descriptions array of (cweId, value))).
    """
    per = F.transform(containers, lambda c: F.transform(c["problemTypes"], lambda p: F.transform(p["descriptions"], lambda d: F.coalesce(F.nullif(d["cweId"], F.lit("")), d["value"]))))
    cleaned = F.transform(F.flatten(F.flatten(per)), lambda v: F.upper(F.trim(v)))
    return F.when(record_id == wanted, F.coalesce(F.array_distinct(F.filter(cleaned, lambda v: v.rlike(CWE))), F.array().cast("array<string>")))


def alternates(distinct: Column, chosen: Column) -> Column:
    """How many other classes than the chosen one were named."""
    return F.size(F.filter(F.coalesce(distinct, F.array().cast("array<string>")), lambda c: c != chosen))


def subsystem_of_urls(urls: Column) -> Column:
    """net, fs, mm or bpf, the first that the first telling URL names; else unassigned."""
    lower = lambda u: F.lower(u)
    one = lambda u: F.when(F.contains(lower(u), F.lit("/net/")), "net").when(F.contains(lower(u), F.lit("/fs/")), "fs").when(F.contains(lower(u), F.lit("/mm/")), "mm").when(F.contains(lower(u), F.lit("bpf")), "bpf")
    named = F.filter(F.transform(F.coalesce(urls, F.array().cast("array<string>")), one), lambda s: s.isNotNull())
    return F.coalesce(F.get(named, F.lit(0)), F.lit("unassigned"))


def subsystem_of_paths(paths: Column) -> Column:
    """The top folder of the first path that has a part, with the next one under drivers; else unassigned."""
    parts = F.filter(
        F.transform(F.coalesce(paths, F.array().cast("array<string>")), lambda p: F.filter(F.split(p, "/"), lambda x: x != "")), lambda x: F.size(x) > 0
    )
    first = F.get(parts, F.lit(0))
    deep = (F.size(first) >= 2) & (F.get(first, F.lit(0)) == "drivers")
    return F.coalesce(F.when(deep, F.array_join(F.slice(first, 1, 2), "/")).otherwise(F.get(first, F.lit(0))), F.lit("unassigned"))


def fix_reference(references: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    """struct(sha, url, full) of the first reference of type FIX that a pattern fits; null if none does.

    references: array of (type, url); patterns: (regular expression whose group is the hash, URL prefix). A full
    hash is put in lower case behind the prefix; an abbreviated one keeps the reference's own URL and full is false.
    """

    def read(r: Column) -> Column:
        out = F.lit(None).cast("struct<sha:string,url:string,full:boolean>")
        for pattern, prefix in reversed(patterns):
            sha = F.regexp_extract(r["url"], pattern, 1)
            full = F.lower(sha).rlike(SHA40)
            found = F.struct(
                F.when(full, F.lower(sha)).otherwise(sha).alias("sha"), F.when(full, F.concat(F.lit(prefix), F.lower(sha))).otherwise(r["url"]).alias("url"), full.alias("full")
            )
            out = F.when(sha != "", found).otherwise(out)
        return out

    typed = F.filter(references, lambda r: r["type"] == "FIX")
    return F.get(F.filter(F.transform(typed, read), lambda x: x.isNotNull()), F.lit(0))


def embed_text(title: Column, labels: Column, claims: Column) -> Column:
    """The text of a record that is embedded: title, labels of nodes and texts of claims, one to a line, blank ones left out."""
    none = F.array().cast("array<string>")
    lines = F.concat(F.array(title), F.coalesce(labels, none), F.coalesce(claims, none))
    return F.array_join(F.filter(lines, lambda s: s.isNotNull() & s.rlike(r"\S")), "\n")
