"""The registered queries, each with the SQL that must give the same rows."""

from mailflow.catalog.registry import ORACLES, QUERIES
from mailflow.catalog import ingest, parsing, quality, enrichment, views, jobs, sql, streams  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
