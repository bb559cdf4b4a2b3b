"""Driver queries, one module per operator family; importing this package registers them."""

from __future__ import annotations

import importlib

from .registry import ORACLES, REGISTRY, query

_MODULES = (
    "listen",
    "columns",
    "relational",
    "series",
    "splits",
    "features",
    "evaluate",
    "io",
    "models",
    "streams",
    "flows",
    "extra",
)


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")


def queries():
    load_all()
    return dict(REGISTRY)


def oracle_sql():
    load_all()
    return dict(ORACLES)


__all__ = ["ORACLES", "REGISTRY", "load_all", "oracle_sql", "queries", "query"]
