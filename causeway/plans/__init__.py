"""Query definitions by area. ``load_all`` imports every module, which registers its queries."""

from importlib import import_module

AREAS = ("relational", "columns", "its", "regress", "forecast", "media", "survival", "graph", "storage")


def load_all() -> None:
    for area in AREAS:
        import_module(f"causeway.plans.{area}")
