"""The registered queries: every operator over the given tables, with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["merging", "scalars", "feeds", "audits", "importing", "landing"]


def load_queries():
    """(queries, SQL) of all modules."""
    for name in _MODULES:
        import_module(f"tidelake.contract.{name}")
    from tidelake.contract.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
