"""All corpus queries and their SQL."""

from __future__ import annotations

from . import decontaminate, hard_negatives, jaccard_join, license_scan, packing, periodic_runs, quality_model, quality_rules, secret_scan, token_counts, toxicity, vector_dedup, warc

_MODULES = (
    secret_scan,
    decontaminate,
    packing,
    quality_model,
    quality_rules,
    jaccard_join,
    warc,
    license_scan,
    toxicity,
    token_counts,
    periodic_runs,
    vector_dedup,
    hard_negatives,
)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}
