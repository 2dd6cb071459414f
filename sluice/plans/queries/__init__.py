"""Registered queries: each operator over the given tables, with its SQL twin."""

from __future__ import annotations

import importlib

from sluice.plans.queries import registry

GROUPS = ["parse", "clean", "enhance", "quality", "filters", "recipes", "audits"]


def _load() -> None:
    for name in GROUPS:
        importlib.import_module(f"sluice.plans.queries.{name}")


def all_queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def all_sql() -> dict:
    _load()
    return dict(registry.SQL)


def flagship(spark, sf_dir: str):
    _load()
    return registry.QUERIES["documents_surviving_filters"](spark, sf_dir)
