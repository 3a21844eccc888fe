"""Reports of small ordered results as Markdown and HTML: findings, clusters, guardrails, reviews, threat models.

Each takes the first `most` rows of an ordered result to the driver and says how many there are in all.
"""

from __future__ import annotations

import html

from pyspark.sql import DataFrame, Row

MOST = 200
STRONG = 0.9


def _rows(frame: DataFrame, most: int) -> tuple[list[Row], str]:
    """(the first rows, a line that tells of what was left out or '')."""
    rows = frame.limit(most + 1).collect()  # a report
    return rows[:most], f"\nOnly the first {most} are shown.\n" if len(rows) > most else ""


def findings_report(found: DataFrame, most: int = MOST) -> str:
    """Findings (file, name, start_line, advisory, s_before, s_after, missing, score) as `matching.match` orders them."""
    rows, more = _rows(found, most)
    if not rows:
        return "# Findings\n\nNo findings.\n"
    strong = sum(r.score >= STRONG for r in rows)
    out = [f"# Findings\n\n{len(rows)} functions to review: {strong} strong (score >= {STRONG}), {len(rows) - strong} weak. Findings are hypotheses, not verdicts.\n{more}"]
    for r in rows:
        out.append(f"## `{r.file}`: `{r.name}` (line {r.start_line}), score {r.score:.2f} ({'strong' if r.score >= STRONG else 'weak'})\n")
        out.append(f"- {r.advisory}: before {r.s_before:.2f}, after {r.s_after:.2f}")
        out += [f"- line {m['line']}: `{m['var']}` goes to `{m['callee']}` unchecked" for m in r.missing]
        out.append("")
    return "\n".join(out).rstrip("\n") + "\n"


def clusters_report(clusters: DataFrame, most: int = MOST) -> str:
    """Clusters (cwe, title, n, with_fix, projects map, examples, preconditions), the largest first."""
    rows, more = _rows(clusters, most)
    out = [f"# Pattern clusters\n{more}"]
    for r in rows:
        shares = ", ".join(f"{p} {n}" for p, n in sorted(r.projects.items()))
        out += [f"## {r.cwe}: {r.title}\n", f"- {r.n} advisories, {r.with_fix} with a fix ({shares})", *(f"- presupposes: {p}" for p in r.preconditions), f"- examples: {', '.join(r.examples)}\n"]
    return "\n".join(out)


def guardrails_report(families: DataFrame, most: int = MOST) -> str:
    """Families of `mining.guardrail_families`: those with citations, then those without."""
    rows, more = _rows(families, most)
    out = [f"# Guardrails\n\n{sum(r.covered for r in rows)} of {len(rows)} families have evidence.\n{more}"]
    for r in sorted(rows, key=lambda r: (not r.covered, r.cwe)):
        out += [f"## {r.cwe}: {r.title}\n", f"- rules: {', '.join(r.rules)}", *(f"- {c['advisory']} fixed in `{c['sha']}` ({c['kind']})" for c in r.citations)]
        out.append("" if r.covered else "- no fix with a full hash is known\n")
    return "\n".join(out)


def review_page(commits: DataFrame, most: int = MOST, files: int = 20) -> str:
    """An HTML table of candidates (sha, advisory, message, files, signals), everything escaped."""
    rows, more = _rows(commits, most)
    safe = lambda v: html.escape("" if v is None else str(v))
    listed = lambda values: "<ul>" + "".join(f"<li><code>{safe(v)}</code></li>" for v in values) + "</ul>"
    body = []
    for r in rows:
        names, signals = list(r.files or [])[:files], list(r.signals or [])
        rest = f"<p>and {len(r.files) - files} more</p>" if r.files and len(r.files) > files else ""
        title = safe((r.message or "").split("\n", 1)[0])
        body.append(f"<tr><td><code>{safe(r.sha)}</code></td><td>{safe(r.advisory or 'UNBOUND')}</td><td>{title}</td><td>{listed(names)}{rest}</td><td>{listed(signals) if signals else 'none'}</td></tr>")
    head = "<tr><th>Commit</th><th>Advisory</th><th>Message</th><th>Files</th><th>Signals</th></tr>"
    return f"<!DOCTYPE html><meta charset=utf-8><title>Review</title><table>{head}{''.join(body)}</table>{f'<p>{more.strip()}</p>' if more else ''}"


def threat_report(name: str, description: str, inputs: list[str], spots: DataFrame, families: DataFrame, most: int = MOST) -> str:
    """A threat model: what people state, the hotspots of `audit.hotspots`, and the covered guardrail families."""
    rows, more = _rows(spots, most)
    known, _ = _rows(families, most)
    out = ["# Threat model\n", f"{name}: {description}\n", "## Untrusted input\n", *([f"- {x}" for x in inputs] or ["- not specified"]), "\n## Hotspots\n"]
    for r in rows:
        detail = "; ".join(f"{g['rule_id']} at {', '.join(map(str, g['lines']))}" for g in r.rules)
        out.append(f"- `{r.path}`: {r.total} findings: {detail}")
    out += ["- none"] if not rows else [more] if more else []
    out += ["\n## Verified fixes of like flaws\n", *([f"- {r.cwe}: {r.title}, {len(r.citations)} cited" for r in sorted(known, key=lambda r: r.cwe) if r.covered] or ["- none"])]
    return "\n".join(out) + "\n"
