"""All registered queries and their SQL counterparts."""

from wayfuse.catalog import ingest, mapping, quality, relational, reports  # noqa: F401
from wayfuse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
