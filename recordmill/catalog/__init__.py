"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from recordmill.catalog import files, ledgers, planning, scanning, statistics, streams
from recordmill.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "ledgers", "planning", "scanning", "statistics", "streams"]
