"""All registered queries and their DuckDB oracles, by name."""

from __future__ import annotations

import importlib

MODULES = [
    "quarry.plans.invoice_plans",
    "quarry.plans.profile_plans",
    "quarry.plans.feature_plans",
    "quarry.plans.io_plans",
    "quarry.plans.model_plans",
]


def _load():
    queries, oracles = {}, {}
    for m in MODULES:
        mod = importlib.import_module(m)
        for k, v in mod.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query name {k}")
            queries[k] = v
        oracles.update(mod.ORACLES)
    return queries, oracles


def queries():
    return _load()[0]


def oracles():
    return _load()[1]
