"""JSON lines read once against Spark's own inference."""

from __future__ import annotations

import pytest

from tablekit.sources import variant

from conftest import write_lines

LINES = ['{"a": 1, "b": "x", "c": 1.5}', '{"a": 2, "d": {"e": [1, 2], "f": null}}', '{"b": null, "c": 2, "z z": true}',
         '{"a": 3, "d": {"e": [], "g": "t"}, "c": 1e3}', "  "]
BAD = ['{"a": 1', "[1, 2]", "7", '"text"', "null", "nonsense"]


def test_schema_and_rows_equal_inference(spark, tmp_dir):
    path = write_lines(tmp_dir, "good.json", LINES)
    want = spark.read.json(path)
    got = variant.read_json_once(spark, path, keep_bad=False)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_bad_lines_are_kept_and_counted(spark, tmp_dir):
    path = write_lines(tmp_dir, "mixed.json", LINES + BAD)
    got = variant.read_json_once(spark, path)
    assert got.columns[-1] == variant.BAD
    assert sorted(r[0] for r in got.where(f"{variant.BAD} is not null").select(variant.BAD).collect()) == sorted(BAD)
    assert got.where(f"{variant.BAD} is not null and coalesce(string(a), b, string(c), string(d)) is not null").isEmpty()
    assert got.count() == 4 + len(BAD)
    assert variant.read_json_once(spark, path, keep_bad=False).count() == 4


@pytest.mark.parametrize("lines", [[], BAD, ["{}"]])
def test_without_a_field(spark, tmp_dir, lines):
    path = write_lines(tmp_dir, "none.json", lines)
    got = variant.read_json_once(spark, path)
    assert got.columns == [variant.BAD] and got.count() == len(lines)


def test_text_is_scanned_once(spark, tmp_dir):
    path = write_lines(tmp_dir, "once.json", LINES)
    records = variant.parse_json_lines(spark, path)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan.lower().replace("context", "") and "parquet" in plan.lower()
