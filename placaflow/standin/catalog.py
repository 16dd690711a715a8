"""All named queries (importing the modules registers them)."""

from placaflow.standin import operators, reports, storage  # noqa: F401
from placaflow.standin.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
