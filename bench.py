"""Benchmark: headline queries on the driver tables, one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 5; one untimed warm-up run first).
The ``job_gold_*`` entries time the gold jobs the way the reference chains
them (race results written, standings read from the written table).
Each run re-plans the query from its parquet inputs and executes it to a
``noop`` sink, so every row is produced; the per-query figure is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "driver_standings",          # flagship: star join -> per-race dedup -> aggregate -> rank
    "constructor_standings",
    "race_results",
    "latest_result_by_snapshot",  # silver dedup shape (newest row per key)
    "upsert_single_key",
    "upsert_update_list",
    "race_circuits",
    "season_trend",
)


def _pipeline_stages(spark, sf_dir, runs, per_query, cold) -> None:
    """The gold jobs as the reference runs them: race results are written
    once, each standings job reads that table, aggregates, ranks, writes."""
    from lapmart.plans import gold, roles
    from lapmart.sources.rawfiles import scratch_dir

    scratch = scratch_dir(spark, "bench")
    s = roles.silver_frames(spark, sf_dir)

    def build_rr(i):
        gold.race_results(s["results"], s["races"], s["circuits"], s["drivers"],
                          s["constructors"]).write.mode("overwrite").parquet(f"{scratch}/rr{i}")

    def build_ds(i):
        rr = spark.read.parquet(f"{scratch}/rr0")
        gold.driver_standings(rr, drivers=s["drivers"]).write.mode("overwrite") \
            .parquet(f"{scratch}/ds{i}")

    def build_cs(i):
        rr = spark.read.parquet(f"{scratch}/rr0")
        gold.constructor_standings(rr, constructors=s["constructors"]).write \
            .mode("overwrite").parquet(f"{scratch}/cs{i}")

    for name, fn in (("job_gold_race_results", build_rr),
                     ("job_gold_driver_standings", build_ds),
                     ("job_gold_constructor_standings", build_cs)):
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(i)
            dt = time.perf_counter() - t0
            if i == 0:
                cold[name] = round(dt, 3)
            else:
                times.append(dt)
        per_query[name] = round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from lapmart.plans import contract
    from lapmart.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app_name="lapmart-bench")
    per_query: dict[str, float] = {}
    cold: dict[str, float] = {}
    _pipeline_stages(spark, sf_dir, runs, per_query, cold)
    for name in HEADLINE:
        fn = contract.QUERIES[name]
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i == 0:
                cold[name] = round(dt, 3)
            else:
                times.append(dt)
        per_query[name] = round(statistics.median(times), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "cold_first_run": cold,
        "flagship": "driver_standings",
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
