"""Imports every module that registers queries."""

from __future__ import annotations

from brickyard.plans import queries_fits, queries_layers, queries_market, queries_models, queries_network  # noqa: F401


def load() -> None:
    """Registration happens on import; the function only makes the import look used."""
