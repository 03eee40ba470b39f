"""Operators against plain-Python brute force on random small inputs."""

from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings, strategies as st

from tablekit.functions import java_split, parse_long_or_zero
from tablekit.operators import relational

TEXT = st.text(alphabet=st.sampled_from(list("ab Ç\t\n\r\f,.x")), max_size=15)
NUMBER_TEXT = st.one_of(
    st.integers(min_value=-10**12, max_value=10**12).map(str),
    st.integers(min_value=0, max_value=10**6).map(lambda i: f"+{i}"),
    st.text(alphabet=st.sampled_from(list("0123456789+-. eE")), max_size=25),
    st.just("9" * 30), st.none())


def tokenizer_tokens(s: str) -> list[str]:
    """java.util.StringTokenizer with its default delimiters."""
    return [t for t in re.split("[ \t\n\r\f]+", s) if t]


def parse_long(s):
    """Long.parseLong or 0."""
    if s is None or not re.fullmatch(r"[+-]?[0-9]+", s):
        return 0
    v = int(s)
    return v if -2**63 <= v < 2**63 else 0


def java_split_py(s: str, sep: str) -> list[str]:
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=30))
def test_word_count_brute_force(spark, lines):
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = {r.word: r.n for r in relational.word_count(df).collect()}
    assert got == dict(Counter(t for s in lines for t in tokenizer_tokens(s)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), NUMBER_TEXT), min_size=1,
                max_size=40))
def test_sum_by_key_or_zero_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r.k: r.total for r in relational.sum_by_key_or_zero(df, "k", "t").collect()}
    want: dict = {}
    for k, t in rows:
        want[k] = want.get(k, 0) + parse_long(t)
    assert got == want
    parsed = [r.p for r in df.select(parse_long_or_zero("t").alias("p")).collect()]
    assert parsed == [parse_long(t) for _, t in rows]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list('a",')), max_size=12), min_size=1,
                max_size=30))
def test_java_split_brute_force(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    got = [r.p for r in df.select(java_split("s", '","').alias("p")).collect()]
    assert got == [java_split_py(s, '","') for s in strings]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from(["Asia", "Europe", "Africa", "Oceania", None]), min_size=1,
                max_size=40))
def test_distinct_set_line_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = relational.distinct_set_line(df, "c").first()[0]
    assert got == ",".join(sorted({v for v in values if v is not None}))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False),
                          st.floats(allow_nan=False, allow_infinity=True),
                          st.integers(-10**7, 10**7).map(lambda i: i / 1000 + 0.0005)),
                min_size=1, max_size=60), st.integers(min_value=0, max_value=8))
def test_round_half_away_equals_sql_round(spark, xs, digits):
    import duckdb
    from tablekit.functions import round_half_away
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = [r.r for r in df.orderBy("i").select(round_half_away("x", digits).alias("r")).collect()]
    con = duckdb.connect()
    want = [con.execute(f"SELECT round(?::DOUBLE, {digits}) + 0.0", [float(x)]).fetchone()[0]
            for x in xs]
    assert got == want
