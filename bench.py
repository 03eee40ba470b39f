"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then timed $BENCH_RUNS times (default 3);
the median is reported. A run executes the whole plan and discards the rows
through the ``noop`` sink, so no result is pulled to the driver.
$BENCH_QUERIES (comma list) picks queries; $BENCH_EVENT_LOG (a folder) writes
Spark's event log, for stage and task times.

Prints one JSON line:
{"metric": "sum_of_median_query_seconds", "value": N, "unit": "sec",
 "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablekit.plans import queries  # noqa: E402
from tablekit.session import get_session  # noqa: E402

HEADLINE = [
    "word_count", "word_count_sink", "normalize_text", "tokenize_lower", "drop_header_equal",
    "typed_delimited", "json_scan", "count_by_key", "sum_by_key_or_zero", "quoted_sum_by_key",
    "distinct_set_line", "grouped_sum", "inner_join_comma", "distinct_projection",
    "split_by_hash", "summary_stats", "corr_with_target", "center_scale", "string_index",
    "tf_idf", "pca_2d", "linreg_report", "text_nb", "kmeans", "random_forest_pca",
    "als_predict", "stream_word_count", "udf_agg",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": "16g"}
    event_log = os.environ.get("BENCH_EVENT_LOG")  # a folder: stage/task times per query
    if event_log:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = get_session(f"local[{cpus}]", app="tablekit-bench",
                        shuffle_partitions=int(cpus) * 2, extra=extra)
    qs = queries()
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = qs[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # the first run warms caches and the JIT
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "master": f"local[{cpus}]", "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
