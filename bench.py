"""Benchmark: the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "total_sec_batch_queries", "value": N, "unit": "sec",
   "queries": {"name": median_sec, ...}, "sf": ..., ...}

Each batch query is run once to warm up, then $BENCH_RUNS times; the median
is reported. A run executes the whole plan into Spark's ``noop`` sink (no
driver collect). The streaming pipeline (both stages over the clicks
replayed in 12-hour micro-batches) is run once and reported separately with
its input rows per second; set BENCH_STREAM=0 to skip it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.session import build_spark, shared_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    with_stream = os.environ.get("BENCH_STREAM", "1") != "0"
    spark = build_spark(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                        app_name="shoplens-bench",
                        extra={"spark.eventLog.enabled": "false"})
    from shoplens.plans import registry as R

    qs = {k: v for k, v in R.QUERIES.items() if not k.startswith("stream_")}
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, fn in qs.items():
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()

    result = {
        "metric": "total_sec_batch_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": dict(times),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
        "rows": rows,
    }
    if with_stream:
        from shoplens import params as P
        from shoplens.streaming.runner import run_ads_pipeline
        clicks = R._ads(spark, sf_dir, P.STREAM_BL_ADS_MOD)
        n_in = clicks.count()
        folder = shared_dir(spark, f"bench-{uuid.uuid4().hex[:8]}")
        t0 = time.perf_counter()
        run_ads_pipeline(clicks, folder, P.STREAM_BATCH_SECONDS, P.STREAM_BL_THRESHOLD,
                         state_partitions=R.REPLAY_PARTITIONS)
        dt = time.perf_counter() - t0
        result["queries"]["stream_pipeline"] = round(dt, 3)
        result["stream_input_rows"] = n_in
        result["stream_rows_per_sec"] = round(n_in / dt, 1)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
