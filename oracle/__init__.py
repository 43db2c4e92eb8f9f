"""Independent DuckDB SQL for the registered queries."""

from __future__ import annotations

import importlib

PARTS = ["oracle.reports", "oracle.jobs", "oracle.star", "oracle.study", "oracle.checks", "oracle.intake", "oracle.streams", "oracle.models"]


def all_sql() -> dict[str, str]:
    from oracle.base import ORACLE, compose

    for part in PARTS:
        importlib.import_module(part)
    return {k: compose(v) for k, v in ORACLE.items()}
