"""Per-stage wall times of one registered query, from Spark's event log (no UI).

python scripts/stage_times.py <query> [sf_dir] [event_dir]

The event log goes to ``event_dir`` (default: a new folder under /tmp, for
local runs only).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def _events(app_dir: str):
    import zstandard

    for f in sorted(glob.glob(os.path.join(app_dir, "events_*"))):
        with open(f, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if f.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                yield json.loads(line)


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    ev_dir = sys.argv[3] if len(sys.argv) > 3 else tempfile.mkdtemp(prefix="bandwise-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{ev_dir}")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from bandwise.plans import registry

    registry.REGISTRY[name].run(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    sc = spark.sparkContext
    sc.setJobGroup("measure", name)
    t0 = time.perf_counter()
    registry.REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    jobs = set(sc.statusTracker().getJobIdsForGroup("measure"))
    app = sc.applicationId
    spark.stop()
    app_dir = next(p for p in glob.glob(os.path.join(ev_dir, f"*{app}*")))
    job_stages, stages = {}, {}
    for e in _events(app_dir):
        if e["Event"] == "SparkListenerJobStart":
            job_stages[e["Job ID"]] = e["Stage IDs"]
        elif e["Event"] == "SparkListenerStageCompleted" and "Submission Time" in e["Stage Info"]:
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"], si["Completion Time"] - si["Submission Time"], si["Stage Name"][:60])
    print(f"{name} at {sf_dir}: wall {wall:.2f}s, {len(jobs)} jobs")
    for j in sorted(jobs):
        for s in job_stages.get(j, []):
            if s in stages:
                n, ms, label = stages[s]
                print(f"  job {j:3d} stage {s:3d} tasks {n:3d} {ms:6d} ms  {label}")


if __name__ == "__main__":
    main()
