"""All registered queries: importing the parts fills the registry."""

from __future__ import annotations

from panelcast.plans import (  # noqa: F401
    catalog_base,
    catalog_linear,
    catalog_quantiles,
    catalog_reports,
    catalog_series,
    catalog_sources,
    catalog_trees,
    catalog_boosting,
    catalog_identities,
)
from panelcast.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
