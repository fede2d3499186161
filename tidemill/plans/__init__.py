"""Registered queries and end-to-end jobs."""

from __future__ import annotations

import importlib
import pkgutil

from tidemill.plans.registry import QUERIES, Query


def load_queries() -> dict[str, Query]:
    """Import every module of this package, then return what they registered."""
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return QUERIES
