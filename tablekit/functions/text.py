"""Text functions (G1-G3, G5, G6, G8, G10, G11) as Column expressions.

All are JVM-side expressions, so they run inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must match the behaviour being reproduced:
# the delimiter set of a default java.util.StringTokenizer (space, tab,
# newline, carriage return, form feed) ...
TOKENIZER_DELIMITERS = "[ \\t\\n\\r\\f]+"
# ... and the character class stripped from book lines before streaming them.
# `!-;` is a range (U+0021 to U+003B), so digits and ( ) & # $ % * + - . / : ;
# are removed as well.
PUNCTUATION_CLASS = "[',!-;\\.\"?]"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whitespace_tokens(c: Column | str) -> Column:
    """G1: tokens split on the StringTokenizer delimiter set, no empty token."""
    return F.filter(F.split(_c(c), TOKENIZER_DELIMITERS, -1), lambda t: t != "")


def space_tokens(c: Column | str) -> Column:
    """``line.split(" ")`` of Python: every empty token is kept."""
    return F.split(_c(c), " ", -1)


def lower_tokens(c: Column | str) -> Column:
    """G3 as an expression: lower-case, split on ``\\s``, trailing empties dropped.

    Same result as ``pyspark.ml.feature.Tokenizer``; leading and inner empty
    tokens stay (Java ``String.split`` semantics).
    """
    # String.split drops the run of empty tokens at the end: cutting trailing
    # whitespace first gives the same tokens with plain built-ins. An empty
    # input has no match and comes back as the one empty token; an all-blank
    # input has only trailing empties and gives no token.
    trimmed = F.regexp_replace(F.lower(_c(c)), "\\s+\\z", "")
    return (F.when(_c(c) == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, "\\s", -1)))


def java_split(c: Column | str, sep: str) -> Column:
    """Split on the literal ``sep`` as Java's ``String.split`` does: trailing
    empty fields are dropped (an empty input stays one empty field; an input
    made only of separators gives no field)."""
    q = re.escape(sep)
    trimmed = F.regexp_replace(_c(c), f"(?:{q})+\\z", "")
    return (F.when(_c(c) == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, q, -1)))


def strip_punctuation(c: Column | str) -> Column:
    """Remove the punctuation/digit class of the book server."""
    return F.regexp_replace(_c(c), PUNCTUATION_CLASS, "")


def remove_char(c: Column | str, ch: str) -> Column:
    """Remove every occurrence of one character."""
    return F.replace(_c(c), F.lit(ch), F.lit(""))


def contains(c: Column | str, token: str) -> Column:
    """Substring containment."""
    return _c(c).contains(token)


def join_sorted(values: Column, sep: str = ",") -> Column:
    """Sort an array of strings and join it with ``sep``."""
    return F.array_join(F.sort_array(values), sep)


def normalize_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """G6 as a job: strip the class, drop lines that became empty.

    Lines made only of blanks stay (only zero-length lines are dropped).
    """
    return (lines.withColumn(col, strip_punctuation(col))
                 .where(F.length(col) > 0))
