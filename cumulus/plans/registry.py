"""All registered queries and their oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ["activity", "dimensional", "analytics", "warehouse", "streams", "experiments"]


def _mods():
    return [importlib.import_module(f"cumulus.plans.{m}") for m in MODULES]


def all_queries():
    out = {}
    for m in _mods():
        for k, v in m.QUERIES.items():
            assert k not in out, k
            out[k] = v
    return out


def all_oracle_sql():
    out = {}
    for m in _mods():
        out.update(m.ORACLE)
    return out
