"""The registered queries, one module per section of the blueprint."""

from importlib import import_module

SECTIONS = ("files", "relational", "features", "statistics", "supervised", "mining", "selection", "jobs")


def load():
    """The registry, filled."""
    for section in SECTIONS:
        import_module(f"loomframe.queries.{section}")
    return import_module("loomframe.queries.registry")
