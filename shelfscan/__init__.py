"""Analytics for product catalogues with tag arrays, written for Spark."""

from shelfscan.session import spark_session

__all__ = ["spark_session"]
