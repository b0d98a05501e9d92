"""Every operator as a query over the given tables."""

from millrace.queries import checks, frames, io, runstate, transforms  # noqa: F401
from millrace.queries.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
