"""All queries of the scholarly-analytics operators: name -> query, name -> DuckDB SQL."""

from __future__ import annotations

import importlib

from quillspark.plans.registry import ORACLES, QUERIES

for _module in ("rollups", "joins", "aggregates", "windows", "sets", "clustering", "texts", "evidence", "stats", "gates", "artifacts", "streams", "choices", "details"):
    importlib.import_module(f"quillspark.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
