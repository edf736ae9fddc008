"""Summarise a Spark event log: the slowest stages and time per job group.

Usage: python tools/stage_times.py <event-log-file-or-folder> [top_n]
Reads the JSON-lines event log Spark writes with spark.eventLog.enabled.
"""

from __future__ import annotations

import io
import json
import os
import sys


def events(path: str):
    """Events of a log file, or of every event file below a folder (Spark 4 rolls
    its log into ``eventlog_v2_*/events_*`` files)."""
    if os.path.isdir(path):
        files = sorted(
            os.path.join(root, f)
            for root, _, names in os.walk(path)
            for f in names
            if not f.startswith((".", "appstatus"))
        )
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
                lines = io.TextIOWrapper(reader, encoding="utf-8")
                yield from (json.loads(ln) for ln in lines if ln.strip())
        else:
            with open(f, encoding="utf-8") as fh:
                yield from (json.loads(ln) for ln in fh if ln.strip())


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:90]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s of stage time (stages may overlap)")
    for ms, sid, tasks, name in stages[:top]:
        print(f"{ms / 1000:7.2f} s  stage {sid:4d}  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
