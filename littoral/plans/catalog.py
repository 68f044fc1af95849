"""All registered queries of the engine's own operators."""

from __future__ import annotations

from littoral.plans import curation, domain, ingest, rates, relational, streams  # noqa: F401  importing registers
from littoral.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
