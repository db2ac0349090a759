"""Benchmark: run the headline queries on $BENCH_SF_DIR (default
/root/testdata/sf0.1) with local[$BENCH_CPUS] and print one JSON line.

Each query is built from scratch and fully executed into the ``noop``
sink (every row computed, nothing collected).  ``BENCH_QUERIES=all`` runs
every registered query; a comma list runs those.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "composite_score", "global_rank", "winner_loser_split", "preference_pairs",
    "attach_sequence", "energy_validation", "validation_summary", "rmsd",
    "descriptors", "nearest_join", "above_p90", "pdb_roundtrip", "stream_score",
]


def task_spread(log_dir: str) -> dict:
    """Per stage with >= 4 tasks: max / median task run time from the event
    log; reports the worst stage (a straggler check for skewed keys)."""
    import glob
    import statistics
    durs: dict = {}
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(f) or "appstatus" in os.path.basename(f):
            continue
        if f.endswith(".zstd"):
            import io

            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"))
            lines = io.TextIOWrapper(raw, encoding="utf-8")
        else:
            lines = open(f, encoding="utf-8")
        with lines as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                ev = json.loads(line)
                info = ev.get("Task Info", {})
                d = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                durs.setdefault((ev.get("Stage ID"), ev.get("Stage Attempt ID")), []).append(d)
    ratios = []
    for key, ds in durs.items():
        if len(ds) >= 4 and statistics.median(ds) > 0 and max(ds) >= 500:
            ratios.append((max(ds) / statistics.median(ds), max(ds), key[0]))
    if not ratios:
        return {"stages_checked": 0}
    worst = max(ratios)
    return {"stages_checked": len(ratios), "worst_max_over_median": round(worst[0], 2),
            "worst_stage": worst[2], "worst_max_ms": worst[1]}


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from seqscore.plans.catalog import QUERIES
    from seqscore.session import local_session
    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if sel == "all" else ([s for s in sel.split(",") if s] or HEADLINE)
    parts = int(os.environ.get("BENCH_PARTITIONS", str(max(8, 2 * int(cpus)))))
    log_dir = None
    if os.environ.get("BENCH_EVENTLOG"):
        # optional: Spark event log in a fresh scratch folder, summarised below
        import tempfile
        log_dir = tempfile.mkdtemp(prefix="seqscore-eventlog-")
    spark = local_session(cpus, parts, driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                          app="seqscore-bench", extra_conf=(
                              {"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"}
                              if log_dir else None))
    # warm-up (not timed): JVM JIT, codegen caches and the Python workers,
    # exercised on the smallest data set
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for w in ("composite_score", "global_rank", "descriptors"):
        QUERIES[w](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir) \
            .write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
           "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus),
           "shuffle_partitions": parts}
    spark.stop()
    if log_dir:
        out["task_spread"] = task_spread(log_dir)
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
