"""Every operator and job placed on the shared test tables, with its oracle."""

from __future__ import annotations

from importlib import import_module

PARTS = ("rows", "linked", "sums", "jobs")


def load():
    """Import all parts and return (queries, oracle) by key."""
    for part in PARTS:
        import_module(f"tallyloom.catalog.{part}")
    from tallyloom.catalog.registry import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
