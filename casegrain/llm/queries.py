"""All queries of this subpackage."""

from __future__ import annotations

import importlib

MODULES = ["lookalike_queries", "canonical_queries", "component_queries", "leak_queries", "pii_queries", "packing_queries", "example_queries"]


def registries() -> list:
    return [importlib.import_module(f"casegrain.llm.{m}").R for m in MODULES]
