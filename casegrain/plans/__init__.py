"""Queries composed of the operators, by theme."""

import importlib

MODULES = ["reference_queries", "cohort_queries", "dataset_queries", "run_queries", "evidence_queries", "source_queries"]


def all_registries() -> list:
    return [importlib.import_module(f"casegrain.plans.{m}").R for m in MODULES]
