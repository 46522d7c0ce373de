"""Every registered query of the measurement engine, and the SQL that gives the same rows."""

from __future__ import annotations

from lineweave.plans import exchange, layers, network, relational, spatial, streets, tables  # noqa: F401  they register their queries
from lineweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
