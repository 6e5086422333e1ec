"""The registered queries and their SQL."""

from docmill.plans.queries import QUERIES, flagship
from docmill.plans.sql import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
