"""Query registry. Each module under ``wattline.plans`` registers its queries
on import; ``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]``
is the DuckDB SQL (absent for rows-only checks).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "wattline.plans.q_cleaning",
    "wattline.plans.q_profiling",
    "wattline.plans.q_compare",
    "wattline.plans.q_ranking",
    "wattline.plans.q_ordering",
    "wattline.plans.q_validate",
    "wattline.plans.q_features",
    "wattline.plans.q_sampling",
    "wattline.plans.q_models",
    "wattline.plans.q_scoring",
]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(m)
