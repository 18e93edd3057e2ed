"""Exercises of every operator on the given test tables (the correctness gate).

Importing this package registers all exercises in ``QUERIES`` / ``ORACLES``.
"""

from sheetmill.exercises import grids, series, sheets, sources_sinks, tables  # noqa: F401
from sheetmill.exercises._registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
