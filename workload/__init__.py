"""Queries over the given tables."""

from importlib import import_module

GROUPS = ("sales", "typing", "quality", "files", "loads")


def load() -> None:
    """Register every group of queries."""
    for group in GROUPS:
        import_module(f"workload.{group}")
