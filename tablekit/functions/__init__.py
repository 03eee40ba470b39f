"""Column-level functions: parsing, recoding, text, vectors."""

from .parse import (LONG_TEXT, impute_sentinel, indicators, numeric_columns,
                    parse_long_or_zero, recode_binary, round_half_away)
from .text import (PUNCTUATION_CLASS, TOKENIZER_DELIMITERS, contains, 
                   java_split,
                   join_sorted, lower_tokens, normalize_lines, remove_char, space_tokens,
                   strip_punctuation, whitespace_tokens)
from .vectors import array_as_vector, assemble, unpack

__all__ = [
    "LONG_TEXT", "impute_sentinel", "indicators", "numeric_columns", "parse_long_or_zero",
    "recode_binary", "round_half_away", "PUNCTUATION_CLASS", "TOKENIZER_DELIMITERS", "contains",
    "java_split", "join_sorted", "lower_tokens", "normalize_lines", "remove_char",
    "space_tokens", "strip_punctuation", "whitespace_tokens", "array_as_vector",
    "assemble", "unpack",
]
