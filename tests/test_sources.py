from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablekit import sinks
from tablekit.sources import tables
from tablekit.sources import (declare_table, drop_lines_containing, drop_lines_equal,
                              labelled_messages,
                              first_line, first_n_lines, literal_table, numbered_lines,
                              quoted_fields, read_declared, read_delimited, read_json,
                              read_lines, read_semicolon_quoted, schema_rows, typed,
                              typed_split)

from conftest import write_lines

HEADER = "MPG,CYLINDERS,NAME"


def test_read_lines_and_min_partitions(spark, tmp_dir):
    path = write_lines(tmp_dir, "a.txt", [f"line {i}" for i in range(50)])
    df = read_lines(spark, path, min_partitions=5)
    assert df.rdd.getNumPartitions() >= 5
    assert df.count() == 50
    assert df.columns == ["value"]


def test_drop_header_equal_drops_every_copy(spark, tmp_dir):
    # header repeated mid-file: the equal-line rule drops both copies
    path = write_lines(tmp_dir, "h.csv", [HEADER, "18.0,8,chevy", HEADER, "15.0,8,buick"])
    lines = read_lines(spark, path)
    kept = [r.value for r in drop_lines_equal(lines).collect()]
    assert kept == ["18.0,8,chevy", "15.0,8,buick"]
    # header=True drops only the first line of the file
    csv = read_delimited(spark, path, "MPG string, CYLINDERS string, NAME string",
                         header=True)
    assert csv.where(F.col("MPG") == "MPG").count() == 1


def test_drop_header_equal_with_frame_header(spark):
    lines = spark.createDataFrame([(1, 1, "h"), (1, 2, "x"), (2, 1, "h"), (2, 2, "y")],
                                  "doc_id long, line_no int, value string")
    header = first_line(lines, ["doc_id", "line_no"])
    assert sorted(r.value for r in drop_lines_equal(lines, header).collect()) == ["x", "y"]


def test_drop_lines_containing_token_anywhere(spark, tmp_dir):
    path = write_lines(tmp_dir, "c.csv", [HEADER, "18.0,8,CYLINDERS special", "15.0,8,buick"])
    kept = [r.value for r in drop_lines_containing(read_lines(spark, path), "CYLINDERS").collect()]
    assert kept == ["15.0,8,buick"]


def test_numbered_lines_and_first_n(spark):
    docs = spark.createDataFrame([(2, "c\nd"), (1, "a\nb\n")], "doc_id long, text string")
    lines = numbered_lines(docs, "doc_id", "text")
    got = [(r.doc_id, r.line_no, r.value) for r in
           first_n_lines(lines, 3, ["doc_id", "line_no"]).collect()]
    assert got == [(1, 1, "a"), (1, 2, "b"), (1, 3, "")]
    # fewer lines than n gives all of them
    assert first_n_lines(lines, 100, ["doc_id", "line_no"]).count() == 5


def test_typed_delimited_permissive_short_rows(spark, tmp_dir):
    # trap 19: a missing trailing field or a bad number is null, quotes stay
    path = write_lines(tmp_dir, "t.csv", ["1,ant,2.5", "x,\"bee\",", "3,cat"])
    df = read_declared(spark, path, "id int, name string, w double")
    rows = sorted(df.collect(), key=lambda r: r.name)
    assert [(r.id, r.name, r.w) for r in rows] == [(None, '"bee"', None), (1, "ant", 2.5),
                                                    (3, "cat", None)]


def test_typed_delimited_failfast_raises(spark, tmp_dir):
    path = write_lines(tmp_dir, "bad.csv", ["1,ant,abc"])
    with pytest.raises(Exception):
        read_delimited(spark, path, "id int, name string, w double").collect()


def test_semicolon_quoted_strips_quotes(spark, tmp_dir):
    path = write_lines(tmp_dir, "bank.csv", ['"age";"marital";"balance"',
                                             '"30";"married";"1787"',
                                             '"33";"single";"-12"'])
    df = read_semicolon_quoted(spark, path, "age double, marital string, balance double")
    assert sorted((r.age, r.marital, r.balance) for r in df.collect()) == [
        (30.0, "married", 1787.0), (33.0, "single", -12.0)]


def test_quoted_fields_keep_outer_quotes(spark, tmp_dir):
    path = write_lines(tmp_dir, "w.csv", ['"AFG","Afghanistan","Asia","x","y","z","22720000"'])
    df = quoted_fields(read_lines(spark, path), {"code": 0, "continent": 2, "pop": 6})
    r = df.first()
    assert (r.code, r.continent, r.pop) == ('"AFG', "Asia", '22720000"')


@pytest.mark.parametrize("line", ['"only","two"', '"only","two","'])
def test_short_quoted_line_raises(spark, tmp_dir, line):
    # the second line ends in a separator: Java's split drops the empty field
    path = write_lines(tmp_dir, "s.csv", [line])
    df = quoted_fields(read_lines(spark, path), {"continent": 2})
    with pytest.raises(PySparkException):
        df.collect()


def test_java_split_semantics(spark):
    from tablekit.functions import java_split
    df = spark.createDataFrame([("a,b,,",), ("",), (",,",), (",a",)], "s string")
    got = [r.p for r in df.select(java_split("s", ",").alias("p")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a"]]


def test_typed_split_casts_strictly(spark, tmp_dir):
    path = write_lines(tmp_dir, "iris.csv", ["5.1,3.5,setosa", "6.2,2.9,virginica"])
    df = typed_split(read_lines(spark, path), ",", [("sl", 0, "double"), ("sw", 1, "double"),
                                                    ("species", 2, "string")])
    assert df.schema.simpleString() == "struct<sl:double,sw:double,species:string>"
    bad = typed_split(read_lines(spark, write_lines(tmp_dir, "b.csv", ["x,1,a"])), ",",
                      [("sl", 0, "double")])
    with pytest.raises(PySparkException):
        bad.collect()


def test_json_inferred_and_schema_rows(spark, tmp_dir):
    path = write_lines(tmp_dir, "w.json", ['{"name":"A","population":12000000,"continent":"Asia"}',
                                           '{"name":"B","population":5,"continent":"Europe"}'])
    df = read_json(spark, path)
    sr = {r.column: r.type for r in schema_rows(spark, df).collect()}
    assert sr == {"continent": "string", "name": "string", "population": "bigint"}
    assert [r.name for r in df.where(F.col("population") > 10000000).collect()] == ["A"]


def test_literal_and_typed(spark):
    df = literal_table(spark, [(1001, 9003), (1001, 9004)], "user int, item int")
    assert df.count() == 2
    t = typed(df, {"u": "user bigint", "i": "item string"})
    assert t.schema.simpleString() == "struct<u:bigint,i:string>"


def test_declare_table_ddl():
    s = declare_table("code string, population int, gnp float")
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "int", "float"]


def test_key_value_sink_raw_and_replaced(spark, tmp_dir):
    out = tmp_dir + "/kv"
    df = spark.createDataFrame([('a"b', 1), ("c", 2)], "word string, n long")
    sinks.write_key_value_text(df, out, "word", "n")
    sinks.write_key_value_text(df, out, "word", "n")  # replaced, not appended
    lines = [r.value for r in spark.read.text(out).collect()]
    assert sorted(lines) == ['a"b\t1', "c\t2"]
    back = sinks.read_key_value_text(spark, out, "word", "n")
    assert sorted((r.word, r.n) for r in back.collect()) == [('a"b', 1), ("c", 2)]


def test_load_overwrite_replaces(spark, tmp_dir):
    out = tmp_dir + "/t"
    df = spark.range(3)
    sinks.load_overwrite(df, out)
    sinks.load_overwrite(df, out)
    assert spark.read.parquet(out).count() == 3


def test_take_bounded(spark):
    assert len(sinks.take_bounded(spark.range(100), 5)) == 5


def test_second_comma_kept_or_cut(spark, tmp_dir):
    path = write_lines(tmp_dir, "sms.csv", ["ham,a,b", "spam,win now", "other,x"])
    lines = read_lines(spark, path)
    kept = [(r.label, r.message) for r in labelled_messages(lines).collect()]
    assert kept == [(0.0, "a,b"), (1.0, "win now"), (1.0, "x")]
    cut = [r.message for r in labelled_messages(lines, truncate_at_comma=True).collect()]
    assert cut == ["a", "win now", "x"]


def test_literal_table_is_plan_literals(spark):
    from tablekit.plans.explain import plan_text
    df = literal_table(spark, [("F", "finished"), ("O", None)], "k string, label string")
    plan = plan_text(df)
    assert "ExistingRDD" not in plan and "EvalPython" not in plan
    assert sorted((r.k, r.label) for r in df.collect()) == [("F", "finished"), ("O", None)]
    assert literal_table(spark, [], "k string").count() == 0


def test_spread_by_files_or_bytes(spark, tmp_dir):
    """Few small files are spread; many files, or files of many splits, are read as they are."""
    path = f"{tmp_dir}/t"
    spark.range(50_000).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    size = tables.scan_bytes(scan)
    assert abs(size - sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))) <= 4096

    def shuffled(df):
        return "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    assert shuffled(tables.spread(scan, ["id"], 4))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split, want in ((f"{size // 4}b", False), (f"{size}", True), ("128m", True), ("1k", False)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            assert shuffled(tables.spread(scan, ["id"], 4)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    many = f"{tmp_dir}/many"
    spark.range(100).repartition(5).write.parquet(many)
    assert not shuffled(tables.spread(spark.read.parquet(many), ["id"], 5))
