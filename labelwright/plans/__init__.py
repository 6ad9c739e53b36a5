"""Named queries over the given tables, each with its SQL where SQL can express it."""

from labelwright.plans import checks, metrics, models, neighbours, noise, reports, streams
from labelwright.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "metrics", "models", "neighbours", "noise", "reports", "streams"]
