"""Registered queries (``queries()``) and their DuckDB oracle SQL (``oracle_sql()``).

Each module contributes ``QUERIES: dict[name, (spark, sf_dir) -> DataFrame]`` and ``ORACLE: dict[name, sql]``.
Queries without an oracle entry are checked by row count only (model fitting, iterative training).
"""

from __future__ import annotations

from riskframe.catalog import federated, fitted, metrics, models, prep, reporting, training

MODULES = [prep, metrics, fitted, models, federated, training, reporting]


def all_queries() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def all_oracle() -> dict:
    out: dict = {}
    for m in MODULES:
        out.update(m.ORACLE)
    return out
