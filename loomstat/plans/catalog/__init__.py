"""The query catalog: every operator on the given tables, with SQL that must agree where possible."""

from loomstat.plans.catalog import factors, files, metrics, models, series, tables  # noqa: F401
from loomstat.plans.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
