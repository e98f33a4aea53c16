"""Per-query stage times from a Spark event log (written by bench.py).

    BENCH_EVENT_LOG=/tmp/run-x python bench.py
    python tools/stage_times.py /tmp/run-x/<app-id>

Prints, per job group (query), the number of jobs, stages and tasks, the
summed stage wall time and the longest stages with their task counts.
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def _lines(files: list[str]):
    """Event lines from plain or zstd-compressed (Spark's default) log files."""
    for f in files:
        if f.endswith(".zstd"):
            import io

            import zstandard

            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main() -> None:
    path = sys.argv[1]
    if os.path.isdir(path):  # rolling (v2) event logs are folders of event files
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    else:
        files = [path]
    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    stages: dict[int, dict] = {}
    for line in _lines(files):
        if line.strip():
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                job_group[ev["Job ID"]] = group
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                if "Completion Time" in info and "Submission Time" in info:
                    stages[info["Stage ID"]] = {
                        "name": info.get("Stage Name", "")[:60],
                        "tasks": info.get("Number of Tasks", 0),
                        "ms": info["Completion Time"] - info["Submission Time"],
                    }
    per_group: dict[str, list] = defaultdict(list)
    jobs_per_group: dict[str, set] = defaultdict(set)
    for sid, st in stages.items():
        job = stage_job.get(sid)
        group = job_group.get(job, "?")
        per_group[group].append((sid, st))
        jobs_per_group[group].add(job)
    for group, items in per_group.items():
        total = sum(st["ms"] for _, st in items)
        tasks = sum(st["tasks"] for _, st in items)
        print(f"{group}: jobs={len(jobs_per_group[group])} stages={len(items)} tasks={tasks} stage_ms={total}")
        for sid, st in sorted(items, key=lambda x: -x[1]["ms"])[:3]:
            print(f"    stage {sid}: {st['ms']} ms, {st['tasks']} tasks, {st['name']}")


if __name__ == "__main__":
    main()
