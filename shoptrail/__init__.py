"""shoptrail: buyer-intent analytics over shopper event logs, on Spark."""

from shoptrail.config import Settings
from shoptrail.session import build_session, materialize, tune

__all__ = ["Settings", "build_session", "materialize", "tune"]
