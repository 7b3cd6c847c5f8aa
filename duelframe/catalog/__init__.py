"""Registered queries, grouped by kind."""

from __future__ import annotations


def load_catalog():
    from . import registry
    from . import gates, quotes, scalar, tables, teams, views  # noqa: F401

    return registry.QUERIES, registry.CHECKS
