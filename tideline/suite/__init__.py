"""Registered queries: every operator run over the given tables, with SQL to match."""

from tideline.suite.registry import ORACLES, QUERIES
from tideline.suite import checks, cleaning, converting, guards, ingest, runs, scans, trust  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
