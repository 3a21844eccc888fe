"""All registered queries: name -> callable and name -> DuckDB SQL."""

from __future__ import annotations

from corvane.plans import advisories, facade, records, relations, retrieval, roundtrips, streams, text  # noqa: F401  they register their queries
from corvane.plans.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
