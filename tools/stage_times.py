"""Per-stage times and task skew of registered queries, from Spark's event log.

    python tools/stage_times.py /root/testdata/sf0.1 log_parse,spend_by_flags

Runs each query once (noop sink) with the event log written to a fresh
scratch folder under /tmp, then prints for every stage: tasks, wall time,
median and max task time (max/median is the skew indicator).  No UI or
server is involved; the log is read as JSON lines.
"""

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.queries import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else list(QUERIES)
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    for n in names:
        spark.sparkContext.setJobDescription(n)
        QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    stages, tasks, stage_job = {}, {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus")]
    for path in sorted(paths):
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description", "")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = e["Stage Info"]
                    stages[info["Stage ID"]] = info
                elif kind == "SparkListenerTaskEnd":
                    t = e["Task Info"]
                    tasks.setdefault(e["Stage ID"], []).append(t["Finish Time"] - t["Launch Time"])
    print(f"{'query':26s} {'stage':>5s} {'tasks':>5s} {'wall ms':>8s} {'med ms':>7s} {'max ms':>7s}  name")
    for sid in sorted(stages):
        info = stages[sid]
        ts = tasks.get(sid, [0])
        wall = info.get("Completion Time", 0) - info.get("Submission Time", 0)
        print(f"{stage_job.get(sid, ''):26s} {sid:5d} {len(ts):5d} {wall:8d} "
              f"{int(statistics.median(ts)):7d} {max(ts):7d}  {info['Stage Name'][:60]}")


if __name__ == "__main__":
    main()
