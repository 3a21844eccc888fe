"""Strings: identifiers, hashes, URLs, paths, versions, families and query terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spelling of identifiers.
SAFE_ID = r"^[A-Z][A-Z0-9]*-[A-Za-z0-9-]+$"
CVE_ID = r"(?i)\bCVE-[0-9]{4}-[0-9]+\b"
CWE_ID = r"^CWE-[0-9]+$"
HEX40 = r"(?<![0-9a-f])[0-9a-f]{40}(?![0-9a-f])"


def is_safe_id(column: Column) -> Column:
    """Whether an identifier can be part of a path."""
    return F.coalesce(column.rlike(SAFE_ID), F.lit(False))


def cwe_number(cwe: Column) -> Column:
    """The number of a well-formed CWE id, else null."""
    return F.when(cwe.rlike(CWE_ID), F.regexp_extract(cwe, "([0-9]+)$", 1).cast("int"))


def full_hashes(texts: Column) -> Column:
    """All stand-alone 40-digit hexadecimal hashes of an array of strings, first seen first, once each."""
    each = F.transform(texts, lambda x: F.regexp_extract_all(F.lower(x), F.lit(HEX40), F.lit(0)))
    return F.array_distinct(F.flatten(each))


def commit_of_url(url: Column) -> Column:
    """The hash in `/commit/` or `?id=` of a URL, else null."""
    found = F.regexp_extract(url, r"(?i)(?:/commit/|[?&]id=)([0-9a-f]{40})\b", 1)
    return F.when(found != "", F.lower(found))


def repository_slug(url: Column) -> Column:
    """Host and path of a repository in lower case, without scheme, trailing slashes and `.git`."""
    bare = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z+]+://(?:[^@/]*@)?", "")
    return F.regexp_replace(F.regexp_replace(bare, r"/+$", ""), r"\.git$", "")


def package_name(name: Column) -> Column:
    """A Python package name in its normal form."""
    return F.lower(F.regexp_replace(name, r"[-_.]+", "-"))


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def path_tokens(path: Column, endings: tuple[str, ...] = ("c", "h", "cc", "cpp", "py", "rs", "go", "js", "java")) -> Column:
    """Parts of a path of two characters or more, without file endings."""
    return F.filter(F.split(F.lower(path), r"[/._-]+"), lambda x: (F.length(x) >= 2) & ~x.isin(*endings))


def version_key(version: Column) -> Column:
    """Sortable key: numbers sort above words, number parts by value, then by their suffix."""
    parts = F.filter(F.split(F.trim(version), r"[.\-+_]+"), lambda x: x != "")

    def part(x: Column) -> Column:
        number = F.regexp_extract(x, "^([0-9]+)", 1)
        is_number = number != ""
        return F.struct(
            F.when(is_number, 1).otherwise(0).alias("kind"),
            F.when(is_number, number.try_cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)")).alias("number"),
            F.when(is_number, F.regexp_extract(x, "^[0-9]+(.*)$", 1)).otherwise(x).alias("rest"),
        )

    return F.transform(parts, part)


def first_fixed(installed: Column, fixed: Column) -> Column:
    """The smallest fixed version above the installed one; if there is none, all of them ascending, joined by ', '."""
    keyed = F.transform(fixed, lambda v: F.struct(version_key(v).alias("key"), v.alias("version")))
    above = F.filter(keyed, lambda x: x["key"] > version_key(installed))
    ascending = F.array_join(F.transform(F.array_sort(keyed), lambda x: x["version"]), ", ")
    return F.when(F.size(above) > 0, F.array_min(above)["version"]).otherwise(ascending)


def rank_of_prefix(value: Column, prefixes: tuple[str, ...]) -> Column:
    """Place of the first prefix that fits; their number if none does."""
    return reduce(lambda rest, kp: F.when(value.startswith(kp[1]), kp[0]).otherwise(rest), reversed(list(enumerate(prefixes))), F.lit(len(prefixes)))


def family(text: Column, rules: list[tuple[str, str]], default: str = "other") -> Column:
    """Name of the first (name, pattern) that the lower-cased text contains."""
    lower = F.lower(text)
    return reduce(lambda rest, rule: F.when(lower.rlike(rule[1]), rule[0]).otherwise(rest), reversed(rules), F.lit(default))


def query_terms(query: Column, most: int = 32) -> Column:
    """Distinct words of a query in lower case, `ß` as `ss`, first seen first."""
    words = F.regexp_extract_all(F.replace(F.lower(query), F.lit("ß"), F.lit("ss")), F.lit(r"(?U)\w+"), F.lit(0))
    return F.slice(F.array_distinct(words), 1, most)


def ids_contained(query: Column, record: Column, pattern: str = CVE_ID) -> Column:
    """Whether all identifiers that the query names are named by the record too."""

    def ids(x: Column) -> Column:
        return F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), F.upper)

    return F.size(F.array_except(ids(query), ids(record))) == 0


def line_of(text: Column, offset: Column) -> Column:
    """1-based line of a 0-based offset."""
    return F.length(F.substring(text, F.lit(1), offset)) - F.length(F.replace(F.substring(text, F.lit(1), offset), F.lit("\n"), F.lit(""))) + 1


def blob_hash(content: Column) -> Column:
    """Git's SHA-1 of a blob: header `blob <bytes>`, a zero byte, the bytes."""
    data = content.cast("binary")
    head = F.concat(F.lit("blob "), F.octet_length(data).cast("string")).cast("binary")
    return F.sha1(F.concat(head, F.lit(bytearray(b"\x00")), data))


def canonical_json(row: Column) -> Column:
    """JSON of a struct whose fields the caller has sorted; nulls are kept."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def trailers(message: Column, kind: str) -> Column:
    """Hashes that lines of a commit message name: kind 'fixes', 'reverts' or 'picks'."""
    pattern = {
        "fixes": r"(?m)^Fixes:\s+([0-9a-f]{12,40})",
        "reverts": r"(?mi)^\s*This reverts commit\s+([0-9a-f]{7,40})\b",
        "picks": r"(?mi)^\s*(?:\(?cherry[ -]picked from commit|Backport(?: of)?(?: commit)?[: ]+)\s*([0-9a-f]{7,40})\b",
    }[kind]
    return F.array_distinct(F.transform(F.regexp_extract_all(message, F.lit(pattern), F.lit(1)), F.lower))


def url_parts(url: Column) -> Column:
    """Struct of scheme, host, path and query; what is missing is empty."""
    return F.struct(
        F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1).alias("scheme"),
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )
