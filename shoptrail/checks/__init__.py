"""Every operator as a query over the given tables, with the SQL it must agree with."""

from shoptrail.checks import event_checks, feature_checks, metric_checks, model_checks, population_checks
from shoptrail.checks.base import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "event_checks",
    "feature_checks",
    "metric_checks",
    "model_checks",
    "population_checks",
]
