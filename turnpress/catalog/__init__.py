"""The registered queries and their checks."""

from turnpress.catalog import cleaning, ordering, parsing, reports, storage, tokens  # noqa: F401
from turnpress.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
