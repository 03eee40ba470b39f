"""Run one named query over a table folder and write its result to a sink.

    spark-submit tools/run_query.py <query> <tables_dir> <out_path> [--format parquet]
    python tools/run_query.py --list

The session comes from the cluster (master, memory, ``spark.checkpoint.dir``
as given to spark-submit); the result is written by the executors, never
collected to the driver.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablekit.plans import queries  # noqa: E402
from tablekit.session import get_session  # noqa: E402


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("query", nargs="?")
    ap.add_argument("tables_dir", nargs="?")
    ap.add_argument("out_path", nargs="?")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--list", action="store_true")
    args = ap.parse_args(argv)
    qs = queries()
    if args.list or not args.query:
        print("\n".join(sorted(qs)))
        return 0
    if args.query not in qs or not args.tables_dir or not args.out_path:
        ap.error("give a known query, a tables folder and an output path")
    spark = get_session(app=f"tablekit-{args.query}")
    df = qs[args.query](spark, args.tables_dir)
    df.write.mode("overwrite").format(args.format).save(args.out_path)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
