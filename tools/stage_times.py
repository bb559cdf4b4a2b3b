"""Summarise a Spark event log: wall time per job and its slowest stages.

usage: python tools/stage_times.py <event-log folder or file> [--top 15]
"""

from __future__ import annotations

import argparse
import glob
import json
import os


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard
        with open(f, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    for f in files:
        if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"):
            for line in _lines(f):
                if line.strip():
                    yield json.loads(line)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=15)
    a = ap.parse_args()
    jobs, stages = {}, {}
    for e in events(a.path):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e.get("Stage IDs", []),
                                 "desc": (e.get("Properties") or {}).get("spark.job.description", "")}
        elif ev == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Completion Time" in info and "Submission Time" in info:
                stages[info["Stage ID"]] = (info["Completion Time"] - info["Submission Time"],
                                            info.get("Number of Tasks"), info.get("Stage Name", "")[:60])
    total = sum(j.get("end", j["start"]) - j["start"] for j in jobs.values())
    print(f"jobs: {len(jobs)}  summed job wall time: {total / 1000:.2f}s  stages: {len(stages)}")
    for sid, (ms, ntasks, name) in sorted(stages.items(), key=lambda kv: -kv[1][0])[: a.top]:
        print(f"stage {sid:5d} {ms / 1000:7.2f}s tasks={ntasks:<5} {name}")


if __name__ == "__main__":
    main()
