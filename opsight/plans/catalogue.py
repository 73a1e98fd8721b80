"""All registered queries."""

from __future__ import annotations

from opsight.plans import catalog, flows, streams, usage  # noqa: F401
from opsight.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
