"""All registered queries.  Importing a module registers its queries."""

from lakeops.registry._base import ORACLE, QUERIES
from lakeops.registry import travel, lookups, players, warehouse, ingest, keyed, streams, ml  # noqa: F401

__all__ = ["QUERIES", "ORACLE"]
