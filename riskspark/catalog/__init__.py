"""The registered queries and, where SQL can state the result, their SQL."""

from riskspark.catalog import admission, basics, delinquency, development, models, outcomes, reports, staging  # noqa: F401
from riskspark.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
