"""One query per operator, on the driver's tables."""

from lakemill.catalogue import changing, cleaning, entities, flows, incremental, joining, measures, models, parsing, storage
from lakemill.catalogue.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "changing", "cleaning", "entities", "flows", "incremental", "joining", "measures", "models", "parsing", "storage",
]
