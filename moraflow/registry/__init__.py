"""Registered queries and their SQL oracles."""

from moraflow.registry.core import ORACLES, QUERIES
from moraflow.registry import (  # noqa: F401  (registration)
    detailed,
    joins_and_facts,
    reports_quality,
    runs,
    scans_and_rules,
)

__all__ = ["ORACLES", "QUERIES"]
