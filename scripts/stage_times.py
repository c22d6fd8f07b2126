"""Summarise a Spark event log: stage time and task count per job group.

    python scripts/stage_times.py <event log file or folder>

Reads the JSON-lines event log Spark writes with ``spark.eventLog.enabled``
(``bench.py`` tags each query's jobs with the query name as job group).
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark 4's default codec)."""
    if path.endswith(".zstd"):
        import io

        import zstandard

        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def summarise(path: str) -> dict[str, dict]:
    if os.path.isdir(path):  # Spark 4 writes rolling logs: a folder of event files per application
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if not f.startswith("."))
    else:
        files = [path]
    stage_group: dict[int, str] = {}
    out: dict[str, dict] = defaultdict(lambda: {"stages": 0, "tasks": 0, "stage_sec": 0.0})
    for f in files:
        if f.endswith(".crc") or os.path.basename(f).startswith("appstatus"):
            continue
        for line in _lines(f):
            if not line.startswith("{"):
                continue
            e = json.loads(line)
            kind = e.get("Event")
            if kind == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id") or "(none)"
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                start, end = info.get("Submission Time"), info.get("Completion Time")
                g = out[stage_group.get(info["Stage ID"], "(none)")]
                g["stages"] += 1
                g["tasks"] += info.get("Number of Tasks", 0)
                if start and end:
                    g["stage_sec"] += (end - start) / 1000.0
    return dict(out)


if __name__ == "__main__":
    for group, s in sorted(summarise(sys.argv[1]).items()):
        print(f"{group:30s} stages={s['stages']:4d} tasks={s['tasks']:6d} stage_sec={s['stage_sec']:.2f}")
