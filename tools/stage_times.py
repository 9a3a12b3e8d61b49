"""Per-stage durations from a Spark event log (file or rolling v2 folder).

    python tools/stage_times.py /tmp/run-XXXX [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def events(path: str):
    files = []
    for p in glob.glob(os.path.join(path, "*")) if os.path.isdir(path) else [path]:
        files += sorted(glob.glob(os.path.join(p, "events_*"))) if os.path.isdir(p) else [p]
    for f in files:
        if f.endswith(".zstd"):                     # Spark 4 compresses event logs with zstd
            import io
            import zstandard
            with open(f, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                for line in text:
                    yield json.loads(line)
        elif not os.path.basename(f).startswith((".", "appstatus")):
            with open(f) as fh:
                for line in fh:
                    yield json.loads(line)


def main() -> None:
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            ms = i.get("Completion Time", 0) - i.get("Submission Time", 0)
            stages.append((ms, i["Stage ID"], i["Number of Tasks"], i["Stage Name"][:60]))
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.2f} s in total")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:8.3f}s  stage {sid:<5} tasks {tasks:<5} {name}")


if __name__ == "__main__":
    main()
