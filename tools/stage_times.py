"""Per-job and per-stage wall times from a Spark event log folder.

usage: python tools/stage_times.py <event-log-dir> [top_n]
"""
from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed."""
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as f:
            yield from f


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for path in sorted(glob.glob(f"{folder}/**/*", recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        for line in _lines(path):
            if line.strip():
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    start, end = info.get("Submission Time"), info.get("Completion Time")
                    if start and end:
                        stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:70]))
    stages.sort(reverse=True)
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s total stage time")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:8.3f}s  stage {sid:5d}  tasks {tasks:4d}  {name}")


if __name__ == "__main__":
    main()
