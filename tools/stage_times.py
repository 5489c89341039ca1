"""Summarise a Spark event log: per stage, task count, task time and the largest task input.

    python tools/stage_times.py <event-log-file-or-folder>

Written for skew checks: a stage whose largest task reads far more records
than the median task is skewed. Uses only the JSON event log Spark writes
with ``spark.eventLog.enabled=true``; no UI or REST endpoint.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def events(path):
    files = [path]
    if os.path.isdir(path):  # a log folder, or a rolling log (eventlog_v2_*/events_*)
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith(".") and "appstatus" not in f)
    for f in files:
        with open(f, "rb") as raw:
            data = raw.read()
        if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import zstandard
            data = zstandard.ZstdDecompressor().stream_reader(
                io.BytesIO(data), read_across_frames=True).read()
        for line in data.decode("utf-8").splitlines():
            if line.strip():
                yield json.loads(line)


def summarise(path):
    tasks = defaultdict(list)
    names = {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerStageSubmitted":
            info = e["Stage Info"]
            names[info["Stage ID"]] = info.get("Stage Name", "")
        elif kind == "SparkListenerTaskEnd":
            info, m = e.get("Task Info", {}), e.get("Task Metrics") or {}
            rec_in = (m.get("Input Metrics", {}).get("Records Read", 0)
                      + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            tasks[e["Stage ID"]].append(
                (info.get("Finish Time", 0) - info.get("Launch Time", 0), rec_in))
    out = []
    for sid in sorted(tasks):
        ts = [t for t, _ in tasks[sid]]
        rs = [r for _, r in tasks[sid]]
        out.append({"stage": sid, "name": names.get(sid, "")[:40], "tasks": len(ts),
                    "max_ms": max(ts), "median_ms": statistics.median(ts),
                    "max_records": max(rs), "median_records": statistics.median(rs),
                    "total_records": sum(rs)})
    return out


if __name__ == "__main__":
    for row in summarise(sys.argv[1]):
        print(json.dumps(row))
