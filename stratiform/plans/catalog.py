"""All registered queries; importing this module registers them."""

from stratiform.plans import queries_fixed, queries_models, queries_tables  # noqa: F401
from stratiform.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
