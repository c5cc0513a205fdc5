"""All queries of the package."""

from lakemill.llm import queries_free, queries_native
from lakemill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queries_free", "queries_native"]
