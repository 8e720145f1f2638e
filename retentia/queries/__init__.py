"""Query registry, one module per operator family."""

import importlib

FAMILIES = ["base", "features", "preparation", "profiling", "statistics", "quality", "evaluation", "sampling", "sources", "modeling"]


def load():
    """(queries, oracles) of all families."""
    from retentia.queries import registry

    for family in FAMILIES:
        importlib.import_module(f"retentia.queries.{family}")
    return registry.QUERIES, registry.ORACLES
