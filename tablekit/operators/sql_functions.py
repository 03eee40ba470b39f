"""User functions for SQL text (L1-L3).

Row functions and predicates whose body is an SQL expression are created as
temporary SQL functions: the optimizer puts the body in place of the call, so no
Python worker takes part. One-to-many functions are table functions in Python,
called with a row (``LATERAL``) or with a table dealt by ``PARTITION BY``.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


def sql_function(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> str:
    """L1/L2: ``name(arguments) RETURNS returns`` with an SQL expression as its body.

    ``arguments`` and ``returns`` are as in DDL (``'x double, y int'``, ``'boolean'``).
    A function of that name is replaced. Returns the name.
    """
    if not re.fullmatch(r"[A-Za-z_]\w*", name):
        raise ValueError(f"not a function name: {name!r}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")
    return name


def table_function(spark: SparkSession, name: str, handler: type, returns: str) -> str:
    """L3: register a one-to-many function for SQL text, moved in Arrow batches.

    ``handler`` has ``eval`` (called per row; with a ``TABLE`` argument it gets the
    row) and optionally ``terminate`` (called at the end of each partition), both
    yielding tuples of the columns in ``returns``. With ``PARTITION BY`` one instance
    sees the rows of one key, as a stream: it has to keep only its own state.
    """
    spark.udtf.register(name, udtf(handler, returnType=returns, useArrow=True))
    return name
