"""Every query of the engine by name, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

from slowtide.catalog.registry import ORACLES, QUERIES

for _part in (
    "source_sink", "columns", "joins", "aggregates", "windows", "slices", "unions", "scalars",
    "learning", "evaluation", "quality", "flows", "streams",
):
    import_module(f"slowtide.catalog.{_part}")

__all__ = ["ORACLES", "QUERIES"]
