"""All registered queries."""

from __future__ import annotations

from obslake.plans import external, ingest, logs, metrics, serving, streams  # noqa: F401
from obslake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
