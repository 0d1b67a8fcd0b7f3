"""Registry of all registered queries and their SQL oracles."""

from __future__ import annotations

import importlib

_MODULES = ["q_clean", "q_split", "q_stats", "q_models", "q_routes", "q_select", "q_geo", "q_sources"]


def _mods():
    return [importlib.import_module(f"farelane.plans.{m}") for m in _MODULES]


def queries() -> dict:
    q = {}
    for m in _mods():
        q.update(m.Q)
    return q


def oracle_sql() -> dict:
    s = {}
    for m in _mods():
        s.update(m.SQL)
    return s
