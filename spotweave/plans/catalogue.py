"""All registered queries of the engine and their SQL."""

from spotweave.plans import analysis, images, rows  # noqa: F401 - they register their queries
from spotweave.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
