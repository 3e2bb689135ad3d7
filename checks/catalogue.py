"""Collects the query modules into one registry."""

from checks import (  # noqa: F401
    datamart_queries,
    metric_queries,
    pit_queries,
    profile_queries,
    source_queries,
)
from checks.views import REGISTRY

__all__ = ["REGISTRY"]
