"""Line positions over split files, and split sizes, against plain Python."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tablekit.sources import positions, splits, text


def folder_of_files(folder):
    """Files of uneven size, an empty one, one without a line end, equal lines, long lines."""
    lines = {}
    for name, n in (("a.txt", 700), ("b.txt", 0), ("c.txt", 1), ("d.txt", 3000), ("e.txt", 40)):
        rows = [f"{name} line {i} " + "x" * (i * 37 % 90) for i in range(n)]
        if n == 3000:
            rows[100] = "long " * 4000
            rows[5] = rows[6] = ""
        lines[name] = rows
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write("\n".join(rows) + ("\n" if name != "c.txt" and rows else ""))
    return lines


@pytest.mark.parametrize("split", [2000, 1 << 27])
def test_positions_equal_plain_reading(spark, tmp_dir, split):
    lines = folder_of_files(tmp_dir)
    session = splits.split_session(spark, split)
    scan = session.read.text(tmp_dir)
    if split == 2000:
        assert scan.rdd.getNumPartitions() > 50
    found = positions.positioned_lines(session, tmp_dir).collect()
    place, want = 0, []
    for name in sorted(lines):
        for k, value in enumerate(lines[name], 1):
            place += 1
            want.append((name, k, place, value))
    assert sorted((os.path.basename(r["file"]), r["line_no"], r["position"], r["value"]) for r in found) == sorted(want)
    values = [w[3] for w in want]
    for n in (1, 701, len(want)):
        got = positions.first_lines_of_files(session, tmp_dir, n).orderBy("position").collect()
        assert [r["value"] for r in got] == values[:n] and [r["position"] for r in got] == list(range(1, n + 1))
    with pytest.raises(IndexError):
        positions.first_lines_of_files(session, tmp_dir, len(want) + 1)
    assert positions.first_lines_of_files(session, tmp_dir, len(want) + 1, strict=False).count() == len(want)
    header = positions.first_line_of_files(session, tmp_dir)
    kept = text.drop_lines_equal(session.read.text(tmp_dir).select("value"), header)
    assert kept.count() == sum(v != values[0] for v in values)


def test_positions_need_no_sort_of_lines(spark, tmp_dir):
    folder_of_files(tmp_dir)
    plan = positions.positioned_lines(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort" not in plan and "SinglePartition" not in plan


def test_a_folder_without_lines(spark, tmp_dir):
    open(f"{tmp_dir}/none.txt", "w").close()
    assert positions.positioned_lines(spark, tmp_dir).count() == 0
    assert positions.first_line_of_files(spark, tmp_dir).count() == 0
    with pytest.raises(IndexError):
        positions.first_lines_of_files(spark, tmp_dir, 1)


def test_split_sizes_give_partitions_without_a_shuffle(spark, tmp_dir):
    lines = folder_of_files(tmp_dir)
    total = sum(map(len, lines.values()))
    assert splits.total_bytes(spark, tmp_dir) == sum(
        os.path.getsize(f"{tmp_dir}/{name}") for name in lines)
    for n in (1, 2, 7, 16):
        got = text.read_lines(spark, tmp_dir, min_partitions=n)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        per = got.groupBy(F.spark_partition_id()).count().collect()
        assert len(per) >= n and sum(r["count"] for r in per) == total
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "0"  # the session's own setting stays


def test_the_split_session_keeps_settings(spark):
    own = splits.split_session(spark, 12345)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "12345"
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert own.conf.get("spark.sql.session.timeZone") == "UTC"
