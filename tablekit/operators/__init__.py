"""DataFrame -> DataFrame operators: relational, profiles, features, models,
evaluation and the user-code surface."""

from . import evaluate, features, models, profile, relational, sparse_text, sql_functions, trees, udfs

__all__ = ["evaluate", "features", "models", "profile", "relational", "sparse_text", "sql_functions", "trees", "udfs"]
