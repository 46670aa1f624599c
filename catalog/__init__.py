"""Registered queries: every operator run over the given tables, with its SQL counterpart."""

from catalog.registry import ORACLES, QUERIES, assemble


def load() -> None:
    """Imports the modules that register queries."""
    from catalog import forecasts, gates, layers, learning, predicates, rollups, statistics, tables, windows  # noqa: F401


__all__ = ["ORACLES", "QUERIES", "assemble", "load"]
