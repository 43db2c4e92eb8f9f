"""Named queries: each takes a Lake and returns a lazy DataFrame.

The plan modules build column expressions at import time, which needs a running session, so they are
imported on first use; CATALOG says which module holds which query.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from freightlens.catalog import CATALOG

QUERIES: dict[str, Callable] = {}


def query(name: str):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        return fn

    return add


def names() -> list[str]:
    return [n for listed in CATALOG.values() for n in listed.split()]


def resolve(name: str) -> Callable:
    """The function of a query; needs an active session."""
    if name not in QUERIES:
        module = next(m for m, listed in CATALOG.items() if name in listed.split())
        importlib.import_module(module)
    return QUERIES[name]
