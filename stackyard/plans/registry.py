"""Collects the named queries of every plan module."""

from __future__ import annotations

import importlib

MODULES = ["q_encode", "q_profile", "q_functions", "q_stats", "q_models", "q_exact"]


def _mods():
    return [importlib.import_module(f"stackyard.plans.{m}") for m in MODULES]


def all_queries():
    out = {}
    for m in _mods():
        dup = set(out) & set(m.QUERIES)
        assert not dup, dup
        out.update(m.QUERIES)
    return out


def all_sql():
    out = {}
    for m in _mods():
        out.update(m.SQL)
    return out
