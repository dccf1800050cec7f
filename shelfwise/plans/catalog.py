"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from shelfwise.plans.registry import ORACLES, QUERIES

for _module in (
    "relational_queries",
    "similarity_queries",
    "feature_queries",
    "text_queries",
    "telemetry_queries",
    "model_queries",
):
    import_module(f"shelfwise.plans.{_module}")

__all__ = ["ORACLES", "QUERIES"]
