"""Queries that are checked against SQL on the same tables."""

import importlib

from fleetrisk.checks import registry

_MODULES = ["mart_queries", "feature_queries", "quality_queries", "model_queries", "source_queries",
            "training_queries", "stream_queries"]


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"fleetrisk.checks.{name}")


def all_queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def all_sql() -> dict:
    _load()
    return dict(registry.SQL)
