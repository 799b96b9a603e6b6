"""Registry of this subpackage's queries and SQL."""

from __future__ import annotations

from . import decontam, filter_audit, importance, langid, line_dedup, metric_search, mixing, near_dedup, pii, quality, toxicity, url_filter, vector_dedup

MODULES = (decontam, toxicity, url_filter, quality, langid, pii, mixing, near_dedup, metric_search, line_dedup, filter_audit, importance, vector_dedup)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for m in MODULES for k, sql in m.ORACLE.items()}
