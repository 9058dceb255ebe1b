"""Registered queries over the sample tables, each with the SQL that must give the same rows."""

from tripflow.catalog.registry import REGISTRY, Query

__all__ = ["REGISTRY", "Query", "load_all"]


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from tripflow.catalog import features, loading, marts, quality, reports, scans, streams  # noqa: F401

    return REGISTRY
