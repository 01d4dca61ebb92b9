"""The registered queries: every operator on the given tables, with SQL to check it."""

from . import (  # noqa: F401
    aggregates,
    composites,
    filters,
    indicators,
    joins,
    rules,
    scalars,
    sinks,
    sources,
    streams,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
