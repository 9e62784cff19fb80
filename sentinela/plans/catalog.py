"""Imports every query module so the registry is filled, and exposes it."""

from __future__ import annotations

import importlib

from sentinela.plans.registry import ORACLE, QUERIES

_MODULES = [
    "sentinela.plans.queries_counts",
    "sentinela.plans.queries_series",
    "sentinela.plans.queries_stats",
    "sentinela.plans.queries_sets",
    "sentinela.plans.queries_text",
    "sentinela.plans.queries_anomaly",
    "sentinela.plans.queries_quality",
    "sentinela.plans.queries_cluster",
    "sentinela.plans.queries_bulletin",
    "sentinela.plans.queries_streaming",
    "sentinela.plans.queries_files",
    "sentinela.plans.queries_country",
]

for _m in _MODULES:
    importlib.import_module(_m)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
