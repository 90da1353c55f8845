"""Composed plans and the registered queries."""

from __future__ import annotations


def registry():
    """All registered queries by name; importing the modules registers them."""
    from seriesforge.plans import (  # noqa: F401
        catalog,
        queries_evaluation,
        queries_features,
        queries_models,
        queries_quality,
        queries_statistics,
    )

    return catalog.REGISTRY
