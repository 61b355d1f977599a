"""Named queries. Importing this package registers every query and oracle."""

from pvspark.plans import bronze, checks, layers, models, publish, retrieval, streams  # noqa: F401
from pvspark.plans.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
