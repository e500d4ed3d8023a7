"""Registered queries over the given tables, each with a reference SQL where one exists."""

from importlib import import_module

_MODULES = ("identities", "gates", "documents", "extractions", "entities", "records", "states", "runs", "landing")


def load_queries():
    """Every registered query by name."""
    from lodegate.plans.registry import REGISTRY

    for module in _MODULES:
        import_module(f"lodegate.plans.{module}")
    return REGISTRY
