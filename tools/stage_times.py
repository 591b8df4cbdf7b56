"""Per-stage wall time of one registered job, from Spark's event log.

    python tools/stage_times.py feature_table [--sf /root/testdata/sf0.1]

The event log goes to a fresh scratch folder; the UI stays off."""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("key")
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--cpus", type=int, default=8)
    a = ap.parse_args(argv)
    logdir = tempfile.mkdtemp(prefix="daycast-eventlog-")
    from daycast.session import get_session
    spark = get_session(f"local[{a.cpus}]", shuffle_partitions=2 * a.cpus,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                               "spark.eventLog.compress": "false"})
    from daycast.registry import QUERIES
    QUERIES[a.key](spark, a.sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    stages = []
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    ms = info.get("Completion Time", 0) - info.get("Submission Time", 0)
                    stages.append((ms, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:60]))
    total = sum(s[0] for s in stages)
    print(f"{a.key}: {len(stages)} stages, {total / 1000:.2f} s summed stage time (log: {logdir})")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:12]:
        print(f"  stage {sid:4d}  {ms / 1000:7.3f} s  {tasks:5d} tasks  {name}")


if __name__ == "__main__":
    main()
