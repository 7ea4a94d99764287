"""Every operator as a query over the test tables, with SQL that checks it."""

from rideframe.catalog import aggregates, analyses, filters, scalars, sources  # noqa: F401
from rideframe.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
