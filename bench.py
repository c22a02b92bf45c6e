"""Time the headline queries: BENCH_SF_DIR (tables), BENCH_CPUS (local cores). Prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (3 by default); the median counts. Shuffle bytes of the median
run come from Spark's event log. The boosters take minutes and run once, only where BENCH_BOOSTERS=1 or they are named.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfspark.plans.catalog import QUERIES  # noqa: E402
from shelfspark.session import local_session  # noqa: E402

# daily facts, cleaning, features, classes, backtest, quality report, and the operators next to them
HEADLINE = {
    "daily_facts": "prune_columns",
    "clean_sales": "clean_sales",
    "build_features": "build_features",
    "prepare_dataset": "prepare_dataset",
    "abc_xyz": "abc_xyz",
    "backtest": "evaluation_table",
    "quality_report": "quality_report",
    "ks_drift": "ks_drift",
    "psi": "psi",
    "describe": "describe",
    "latency_quantiles": "latency_quantiles",
    "lockout": "lockout_batch",
    "profile": "profile",
    "outliers_iqr": "outliers_iqr",
    "moving_average": "moving_average",
    "stream_ingest": "stream_ingest",
}
BOOSTERS = {"forecast_all": "forecast_all", "backtest_models": "backtest_models"}


def shuffled(events: str, spans: dict[str, tuple[float, float]]) -> dict[str, float]:
    """MB that the tasks begun within each span wrote to shuffles."""
    out = dict.fromkeys(spans, 0.0)
    for name in os.listdir(events):
        with open(os.path.join(events, name), errors="replace") as lines:
            for line in lines:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                event = json.loads(line)
                began = event["Task Info"]["Launch Time"] / 1000
                written = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                for query, (start, end) in spans.items():
                    if start <= began <= end:
                        out[query] += written / 1e6
    return {k: round(v, 2) for k, v in out.items()}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    known = HEADLINE | BOOSTERS
    wanted = sys.argv[1:] or list(known if os.environ.get("BENCH_BOOSTERS") == "1" else HEADLINE)
    events = tempfile.mkdtemp(prefix="bench-events-")
    spark = local_session(
        cores, memory="16g", spark__sql__shuffle__partitions=cores, spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file://{events}", spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> tuple[float, float]:
        start = time.time()
        QUERIES[known[name]](spark, folder).write.format("noop").mode("overwrite").save()
        return start, time.time()

    spans: dict[str, tuple[float, float]] = {}
    for name in wanted:
        if name not in BOOSTERS:
            run(name)
        each = sorted((run(name) for _ in range(1 if name in BOOSTERS else runs)), key=lambda s: s[1] - s[0])
        middle = statistics.median_low([end - start for start, end in each])
        spans[name] = next(s for s in each if s[1] - s[0] == middle)
    spark.stop()
    times = {name: round(end - start, 3) for name, (start, end) in spans.items()}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale, "runs": runs, "shuffle_mb": shuffled(events, spans),
    }))


if __name__ == "__main__":
    main()
