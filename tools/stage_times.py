"""Stage and task times from a Spark event log folder (as bench.py writes it).

    python tools/stage_times.py <event_log_dir> [top_n]

Prints the slowest stages: id, name, tasks, seconds, and the longest task.
Reads plain or zstd-compressed (Spark's default codec) event files.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    with open(path, "rb") as f:
        raw = f.read()
    if path.endswith(".zstd"):
        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode("utf-8", errors="replace").splitlines()


def main(argv) -> None:
    root = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stages, longest = {}, {}
    files = [f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
             if os.path.isfile(f) and "appstatus" not in os.path.basename(f)]
    for path in files:
        for line in _lines(path):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            kind = e.get("Event")
            if kind == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"], secs)
            elif kind == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                secs = (ti["Finish Time"] - ti["Launch Time"]) / 1000
                sid = e["Stage ID"]
                longest[sid] = max(longest.get(sid, 0.0), secs)
    rows = sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]
    print(f"{'stage':>6} {'tasks':>6} {'sec':>7} {'max task':>8}  name")
    for sid, (name, tasks, secs) in rows:
        print(f"{sid:>6} {tasks:>6} {secs:>7.2f} {longest.get(sid, 0.0):>8.2f}  {name}")


if __name__ == "__main__":
    main(sys.argv)
