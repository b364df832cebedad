"""All checked queries and their SQL, for the driver, the tests and the benchmark."""

from stormglass.catalog import archive_queries, index_queries, reaction_queries  # noqa: F401
from stormglass.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
