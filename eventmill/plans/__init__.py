"""Registered queries, one module per family of operators."""

import importlib

FAMILIES = (
    "sources",
    "parsing",
    "joins",
    "aggregates",
    "ranking",
    "sets",
    "scalars",
    "windows",
    "patterns",
    "udfs",
    "streams",
    "models",
)


def load_all():
    for family in FAMILIES:
        importlib.import_module(f"eventmill.plans.{family}")
    return importlib.import_module("eventmill.plans.registry")
