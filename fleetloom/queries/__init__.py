"""All registered queries; importing the modules registers them."""

from fleetloom.queries import bands, calendar, checks, cleanse, flagship, ingest, order, purge, tables  # noqa: F401
from fleetloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
