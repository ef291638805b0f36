"""All queries register on import."""

from basketlens.queries import aggregates, flagging, io, modelling, relational  # noqa: F401
from basketlens.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
