"""Value parsing and recoding (B7-B10, B13, G7) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Fixed value: the text `Long.parseLong` accepts (optional sign, digits only;
# no blanks, no decimal point).
LONG_TEXT = "^[+-]?[0-9]+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_long_or_zero(c: Column | str) -> Column:
    """The integer in ``c`` or 0 when it does not parse (or overflows)."""
    c = _c(c)
    return F.coalesce(F.when(c.rlike(LONG_TEXT), c.try_cast("bigint")),
                      F.lit(0).cast("bigint"))


def recode_binary(c: Column | str, match: str, if_match: float, otherwise: float) -> Column:
    """``if_match`` when ``c == match`` else ``otherwise`` (nulls too)."""
    return F.when(_c(c) == F.lit(match), F.lit(float(if_match))).otherwise(
        F.lit(float(otherwise)))


def indicators(c: Column | str, values: dict[str, str]) -> list[Column]:
    """One 1.0/0.0 flag per listed value; unlisted values give all zeros."""
    return [F.when(_c(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(name)
            for name, v in values.items()]


def impute_sentinel(c: Column | str, value: float, sentinel: str = "?") -> Column:
    """The sentinel becomes a constant, any other text a strict double.

    The constant is a literal folded into the generated code: no broadcast
    variable is needed for a shared scalar.
    """
    c = _c(c)
    return F.when(c == F.lit(sentinel), F.lit(float(value))).otherwise(c.cast("double"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Numeric columns decided by the schema, not by a first-row probe."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def round_half_away(c: Column | str, digits: int) -> Column:
    """``round(x, digits)`` on doubles as plain double arithmetic: the nearest
    multiple of ``10^-digits`` (``x * 10^digits`` rounded half away from zero,
    divided back), with -0.0 made 0.0. Stays in generated code, unlike the
    decimal-based ``round``; NaN and infinities pass through, and so does a
    value whose scaled form overflows. At or above 2^52 ``x * 10^digits`` is
    already a whole number, so it is only divided back.
    """
    x = _c(c).cast("double")
    m = F.lit(10.0 ** digits)
    y = F.abs(x) * m
    whole = F.when(y >= F.lit(2.0 ** 52), y).otherwise(F.floor(y + F.lit(0.5)).cast("double"))
    r = F.signum(x) * whole / m + F.lit(0.0)
    return F.when(F.isnan(r) | (F.abs(r) == F.lit(float("inf"))), x).otherwise(r)
