"""Benchmark of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 5: the median of five runs of each query, after one warm-up
Each query runs to completion through the no-op sink, so nothing is collected.
Shuffle bytes per query are read back from Spark's event log, written to a
fresh scratch folder (no UI, no server).
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from readyspark.session import build_session  # noqa: E402
from readyspark.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "clean_applications",      # prepare, P1-P9
    "clean_reason_counts",     # P9 reasons
    "rule_suite_raw",          # fused expectations, E1-E9
    "rule_suite_prepared",
    "group_quartiles",         # exact quantiles, A5
    "histogram",               # A6
    "exact_split",             # T1
    "classification_metrics",  # M1-M8
    "separation_gap",          # G1-G2
    "robustness_gate",         # V1-V2 with X1, G4
    "metamorphic_gate",        # V3-V5 with X1, G5-G6
    "gate_report",             # everything, G8
    "onehot_wide",             # fitted encoder, L2
    "forest_scores",           # one forest fitted and applied, L4, L8, L9
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    log_dir = tempfile.mkdtemp(prefix="bench-events-")
    spark = build_session(f"local[{cpus}]", app_name="readyspark-bench", shuffle_partitions=cpus * 2,
                          conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                "spark.eventLog.compress": "false"})
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-ckpt-"))
    QUERIES["sorted_classes"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    timings = {}
    for name in HEADLINE:
        runs = []
        for r in range(repeat):
            spark.sparkContext.setJobGroup(f"{name}#{r}", name)
            t = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)
    total = round(sum(timings.values()), 3)
    spark.stop()
    shuffle, rows_in = stage_metrics(log_dir, repeat)
    rows_per_sec = {k: round(rows_in[k] / timings[k]) for k in timings if rows_in.get(k) and timings[k] > 0}
    print(json.dumps({"metric": "headline_total_time", "value": total, "unit": "sec",
                      "queries": timings, "shuffle_mb": shuffle, "input_rows": rows_in,
                      "rows_per_sec": rows_per_sec, "sf": sf, "cpus": cpus, "repeat": repeat}))


def stage_metrics(log_dir: str, repeat: int) -> tuple[dict, dict]:
    """Shuffle bytes written (MB) and input rows read per query and run, from
    the event log. Input rows count every scan, including reads of the
    query's own lineage-cut tables."""
    stage_group, written, read = {}, {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    sid = ev.get("Stage ID")
                    written[sid] = written.get(sid, 0) + m.get("Shuffle Bytes Written", 0)
                    inp = (ev.get("Task Metrics") or {}).get("Input Metrics") or {}
                    read[sid] = read.get(sid, 0) + inp.get("Records Read", 0)

    def per_query(values: dict) -> dict:
        out = {}
        for sid, v in values.items():
            group = stage_group.get(sid)
            if group:
                name = group.split("#")[0]
                out[name] = out.get(name, 0) + v
        return out

    shuffle = {k: round(v / repeat / 1e6, 3) for k, v in per_query(written).items()}
    rows = {k: round(v / repeat) for k, v in per_query(read).items()}
    return shuffle, rows


if __name__ == "__main__":
    main()
