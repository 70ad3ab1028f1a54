"""Queries over the test tables, each with the SQL that gives the same result."""

from rangeload.catalog import filters, incremental, ranges, scans, stats, streams
from rangeload.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "filters", "incremental", "ranges", "scans", "stats", "streams"]
