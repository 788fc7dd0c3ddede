"""Every operator and analysis as a runnable query, next to the SQL it is checked against."""

from eventloom.suite import analyses, files, inspection, relational, rectangling, scalars  # noqa: F401
from eventloom.suite.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
