"""All registered queries. Importing the plan modules fills the registry."""

from __future__ import annotations

from tabwright.plans import cleaning, learning, relational, statistics, storage, validation  # noqa: F401
from tabwright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
