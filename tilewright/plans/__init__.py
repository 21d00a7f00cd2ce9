"""Registered queries over the generated tables."""

from __future__ import annotations

from importlib import import_module

from tilewright.plans import registry

MODULES = ("scalar_queries", "spatial_queries", "search_queries", "build_queries", "audit_queries")


def all_queries() -> dict[str, registry.Query]:
    for module in MODULES:
        import_module(f"tilewright.plans.{module}")
    return dict(registry.QUERIES)
