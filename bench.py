"""Benchmark: the headline load operators on the driver tables.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line: total wall time, per-query seconds, and per query the
shuffle bytes written and the slowest / median task time, read from Spark's
own event log written to a fresh scratch folder (no UI, no server).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from wingspan.plans.queries import QUERIES, flagship  # noqa: E402

HEADLINE = ["count_fact", "distinct_on", "batch_number", "scheme_replace", "visit_fact", "site_dim",
            "load_audit", "merge_checklist", "key_violations", "fk_violations", "cascade_delete",
            "section_length_check", "geo_dim"]


def session(cpus: str, event_dir: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("wingspan-bench")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", event_dir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )


def task_metrics(event_dir: str) -> dict[str, dict]:
    """Per job group: shuffle bytes written, slowest and median task run time (ms)."""
    files = sorted(f for f in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in os.path.basename(f))
    stage_group: dict[int, str] = {}
    per: dict[str, dict] = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if not group:
                        continue
                    m = ev.get("Task Metrics") or {}
                    d = per.setdefault(group, {"shuffle_bytes": 0, "tasks": []})
                    d["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    d["tasks"].append(m.get("Executor Run Time", 0))
    out = {}
    for g, d in per.items():
        t = d["tasks"] or [0]
        out[g] = {"shuffle_bytes": d["shuffle_bytes"], "tasks": len(d["tasks"]), "max_task_ms": max(t),
                  "median_task_ms": statistics.median(t)}
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    event_dir = tempfile.mkdtemp(prefix="wingspan-bench-events-")
    spark = session(cpus, event_dir)
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    # warm-up: JVM, file listing, codegen caches (on the smallest tables at hand)
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    flagship(spark, small if os.path.isdir(small) else sf).collect()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        try:
            # a noop write evaluates every column (a count would let the optimizer drop them)
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = repr(exc)[:300]
        times[name] = round(time.perf_counter() - t0, 3)
    sc.setJobGroup("done", "done")
    spark.stop()
    metrics = task_metrics(event_dir)
    total = round(sum(times.values()), 3)
    sfv = sf.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_wall", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sfv) if sfv.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "median_query": statistics.median(times.values()),
                      "task_metrics": {k: metrics.get(k, {}) for k in names}, "errors": errors}))


if __name__ == "__main__":
    main()
