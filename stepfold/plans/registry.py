"""All registered queries (``queries()``) and their DuckDB oracles."""

from __future__ import annotations

import importlib

from stepfold.plans.finalize import normalize_sql

# Query modules, one per area of SURVEY §2.
MODULES = ["q_logs", "q_bench", "q_ops", "q_router", "q_corpus", "q_catalog", "q_kernels", "q_hlo"]


def _load():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"stepfold.plans.{m}")
        for k in mod.QUERIES:
            if k in queries:
                raise ValueError(f"duplicate query {k}")
        queries.update(mod.QUERIES)
        oracle.update({k: normalize_sql(v) for k, v in mod.ORACLE.items()})
    return queries, oracle


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
