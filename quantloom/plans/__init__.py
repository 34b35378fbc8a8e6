"""Specifications, recipes and queries."""

from . import more_queries  # noqa: F401  registers its queries
