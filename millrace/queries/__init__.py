"""Checked queries over the supplied tables."""

from __future__ import annotations

import importlib

MODULES = ["relational", "aggregates", "changes", "texts", "jobs", "streams", "inputs"]


def _load():
    from millrace.queries import registry

    for name in MODULES:
        importlib.import_module(f"millrace.queries.{name}")
    return registry


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)


def coverage():
    return dict(_load().COVERS)
