"""Named queries over the test tables, their SQL oracles and plan checks."""

from . import model_queries, source_queries
from .oracles import oracle_sql as _base
from .queries import queries


def oracle_sql() -> dict[str, str]:
    return _base() | model_queries.ORACLES | source_queries.ORACLES


__all__ = ["oracle_sql", "queries"]
