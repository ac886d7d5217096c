"""Summarise a Spark event log (plain or zstd): per SQL execution, its jobs,
stages, task counts, stage seconds and the slowest task.

    python tools/stages.py <event-log-dir-or-file>
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(target: str) -> None:
    files = sorted(glob.glob(os.path.join(target, "**", "events_*"), recursive=True)) \
        if os.path.isdir(target) else [target]
    stages, jobs, tasks, execs = {}, {}, collections.defaultdict(list), {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                s = e["Stage Info"]
                stages[s["Stage ID"]] = (s["Number of Tasks"],
                                         (s["Completion Time"] - s["Submission Time"]) / 1000)
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"],
                                     e.get("Properties", {}).get("spark.sql.execution.id"), None]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][3] = (e["Completion Time"] - jobs[e["Job ID"]][0]) / 1000
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks[e["Stage ID"]].append((ti["Finish Time"] - ti["Launch Time"]) / 1000)
            elif ev.endswith("SparkListenerSQLExecutionStart"):
                execs[e["executionId"]] = [e["description"][:60], e["time"], None]
            elif ev.endswith("SparkListenerSQLExecutionEnd"):
                if e["executionId"] in execs:
                    execs[e["executionId"]][2] = (e["time"] - execs[e["executionId"]][1]) / 1000
    by_exec = collections.defaultdict(list)
    for j, (_, ids, x, dur) in sorted(jobs.items()):
        by_exec[x].append((j, ids, dur))
    for x, js in by_exec.items():
        head = execs.get(int(x)) if x is not None else None
        print(f"exec {x} {head[2] if head else ''}s {head[0] if head else ''}")
        for j, ids, dur in js:
            parts = []
            for i in ids:
                if i in stages:
                    n, d = stages[i]
                    parts.append(f"s{i}:{n}t/{d:.2f}s/max{max(tasks[i]) if tasks[i] else 0:.2f}")
            print(f"   job {j} {dur}s  " + " ".join(parts))


if __name__ == "__main__":
    main(sys.argv[1])
