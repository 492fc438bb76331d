"""DuckDB oracle SQL, one module per case study."""

from __future__ import annotations

import importlib


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for n in range(1, 9):
        try:
            mod = importlib.import_module(f"{__name__}.case{n}")
        except ModuleNotFoundError:
            continue
        out.update(mod.SQL)
    return out
