"""All registered queries."""

from tickwarden.plans import detection, evaluation, preparation, serving, statistics  # noqa: F401
from tickwarden.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
