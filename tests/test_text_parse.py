from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.ml.feature import Tokenizer

from tablekit.functions import (impute_sentinel, indicators, lower_tokens, normalize_lines,
                                numeric_columns, parse_long_or_zero, recode_binary,
                                remove_char, space_tokens, strip_punctuation,
                                whitespace_tokens)
from tablekit.operators.relational import sum_by_key_or_zero, word_count


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "s string").select(expr("s").alias("o")).first().o


def test_three_tokenisers_differ(spark):
    s = "a  b "
    assert one(spark, s, whitespace_tokens) == ["a", "b"]
    assert one(spark, s, space_tokens) == ["a", "", "b", ""]
    assert one(spark, s, lower_tokens) == ["a", "", "b"]
    assert one(spark, " A  b\tC ", lower_tokens) == ["", "a", "", "b", "c"]
    assert one(spark, "a\tb\fc\r\nd", whitespace_tokens) == ["a", "b", "c", "d"]
    assert one(spark, "", lower_tokens) == [""]
    assert one(spark, "   ", lower_tokens) == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBc \t\n\rÉ.")), max_size=12),
                min_size=1, max_size=40))
def test_lower_tokens_equals_ml_tokenizer(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    both = Tokenizer(inputCol="s", outputCol="ml").transform(df).select(
        "ml", lower_tokens("s").alias("ours"))
    for r in both.collect():
        assert r.ml == r.ours


def test_word_count_is_case_sensitive(spark):
    df = spark.createDataFrame([("elma kiraz Elma",), ("kiraz\telma",)], "value string")
    got = {r.word: r.n for r in word_count(df).collect()}
    assert got == {"elma": 2, "Elma": 1, "kiraz": 2}


def test_strip_punctuation_class_has_a_range(spark):
    s = "It's 12:30; \"yes\" (ok) a-b? @x=1 <z>"
    assert one(spark, s, strip_punctuation) == "Its  yes ok ab @x= <z>"


def test_normalize_drops_only_empty_lines(spark):
    df = spark.createDataFrame([("1234;",), ("  ",), ("Hi!",)], "value string")
    assert sorted(r.value for r in normalize_lines(df).collect()) == ["  ", "Hi"]


def test_remove_char(spark):
    assert one(spark, '"a";"b"', lambda c: remove_char(c, '"')) == "a;b"


@pytest.mark.parametrize("text,expected", [
    ("12", 12), ("+5", 5), ("-3", -3), ("12.5", 0), (" 7", 0), ("", 0), ("NULL", 0),
    ("1" * 30, 0), (None, 0)])
def test_parse_long_or_zero(spark, text, expected):
    assert one(spark, text, parse_long_or_zero) == expected


def test_group_with_only_bad_numbers_appears(spark):
    df = spark.createDataFrame([("Asia", "10"), ("Asia", "x"), ("X", "1.5"), ("X", "")],
                               "k string, t string")
    got = {r.k: r.total for r in sum_by_key_or_zero(df, "k", "t").collect()}
    assert got == {"Asia": 10, "X": 0}


def test_impute_sentinel_and_strict_cast(spark):
    assert one(spark, "?", lambda c: impute_sentinel(c, 80.0)) == 80.0
    assert one(spark, "130", lambda c: impute_sentinel(c, 80.0)) == 130.0
    with pytest.raises(PySparkException):
        one(spark, "abc", lambda c: impute_sentinel(c, 80.0))


def test_recode_else_branch(spark):
    df = spark.createDataFrame([("two",), ("four",), (None,)], "d string")
    got = [r.o for r in df.select(recode_binary("d", "two", 1.0, 2.0).alias("o")).collect()]
    assert got == [1.0, 2.0, 2.0]


def test_indicators_unlisted_all_zero(spark):
    df = spark.createDataFrame([("married",), ("widowed",)], "m string")
    flags = df.select(*indicators("m", {"single": "single", "married": "married",
                                        "divorced": "divorced"}))
    rows = [tuple(r) for r in flags.collect()]
    assert rows == [(0.0, 1.0, 0.0), (0.0, 0.0, 0.0)]


def test_numeric_columns_by_schema_not_first_row(spark):
    df = spark.createDataFrame([(None, 1.0, 3)], "name string, x double, y int")
    assert numeric_columns(df) == ["x", "y"]


def test_text_functions_stay_in_codegen(spark):
    from tablekit.plans.explain import plan_text
    df = spark.createDataFrame([("a b",)], "value string")
    plan = plan_text(word_count(df))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
