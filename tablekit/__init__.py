"""tablekit: user-level table, text, statistics, ML and stream operators on PySpark.

Every operator is a DataFrame -> DataFrame function (or a fitted Spark ML
model) built from Spark's own expressions, so Catalyst prunes, pushes down and
code-generates it and the cluster scales it.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from .session import checkpoint_root, get_session, scale_conf, scratch_path

# Functions of this package that run inside tasks (pandas UDFs, mapInPandas
# bodies) are shipped by value, so executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["checkpoint_root", "get_session", "scale_conf", "scratch_path"]
