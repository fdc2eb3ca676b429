"""Print job and stage durations from a Spark event log folder (zstd or plain)."""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb")
    if path.endswith(".zstd") or path.endswith(".zst"):
        reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
        return io.TextIOWrapper(reader, encoding="utf-8", errors="replace")
    return io.TextIOWrapper(raw, encoding="utf-8")


def main(folder):
    stages, jobs = {}, {}
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in lines(f):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                i = e["Stage Info"]
                stages[i["Stage ID"]] = (i["Stage Name"][:50], i["Number of Tasks"],
                                         i.get("Completion Time", 0) - i.get("Submission Time", 0))
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = e["Submission Time"]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]] = (jobs[e["Job ID"]] % 100000, e["Completion Time"] - jobs[e["Job ID"]])
    for k, v in sorted(stages.items()):
        print("stage", k, v)
    for k, v in sorted(jobs.items()):
        print("job", k, v)


if __name__ == "__main__":
    main(sys.argv[1])
