"""Plan inspection: the formatted physical plan as text, for plan assertions."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator name in the formatted plan's tree."""
    tree = plan_text(df).split("\n\n")[0]
    return tree.count(name)
