"""Per-job and per-stage wall times from a Spark event log.

    python tools/stage_times.py <event-log-file-or-folder> [top_n]

Prints the slowest stages with their task count and the job they belong to.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path):
    """Lines of an event log: a file, or a rolling-log folder of
    ``events_*`` files, plain or zstd-compressed."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for fp in files:
        if fp.endswith(".zstd"):
            import zstandard
            with open(fp, "rb") as raw:
                reader = zstandard.ZstdDecompressor().stream_reader(raw)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(argv):
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stages, jobs = {}, {}
    stage_job = {}
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                jobs[ev["Job ID"]] = {"start": ev["Submission Time"], "stages": ev["Stage IDs"]}
                for sid in ev["Stage IDs"]:
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerJobEnd":
                jobs[ev["Job ID"]]["end"] = ev["Completion Time"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Submission Time" in info and "Completion Time" in info:
                    stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                                info["Number of Tasks"], info["Stage Name"][:60])
    total = sum(j.get("end", j["start"]) - j["start"] for j in jobs.values())
    print(f"jobs: {len(jobs)}  stages: {len(stages)}  job wall ms (sum): {total}")
    for sid, (ms, tasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[:top]:
        print(f"stage {sid:5d} job {stage_job.get(sid, -1):5d} {ms:7d} ms {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main(sys.argv)
