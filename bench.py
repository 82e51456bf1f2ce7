"""Time the headline queries: one warm-up, then the median of three runs each.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopfloor.plans.registry import queries
from shopfloor.session import drop_staged, get_spark

HEADLINE = [
    "q_silver_runs", "q_silver_sensors", "q_quarantine_runs", "q_load_audit", "q_run_oee", "q_oee_by_machine",
    "q_oee_by_line", "q_daily_oee", "q_rolling_oee", "q_weekly_oee", "q_shift_performance", "q_running_downtime",
    "q_rank_in_line", "q_loss_taxonomy", "q_downtime_pareto", "q_sensor_agg", "q_quality_agg", "q_machine_health",
    "q_failure_risk", "q_top_risk", "q_scd2_apply", "q_scd2_as_of", "q_fact_upsert", "q_bronze_json_roundtrip",
    "q_wear_percent_rank", "q_stratified_split", "q_auc", "q_scd2_merge", "q_stream_upsert", "q_stream_bronze", "q_cv_folds",
    "q_ml_predictions", "q_gold_incremental", "q_scd2_as_of_many", "q_stream_gate", "q_permutation_importance",
]

# Queries that take long: timed once, without a warm-up of their own.
SINGLE = {"q_ml_predictions", "q_gold_incremental"}


def timed(fn, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    drop_staged(spark)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}
    for name in names:
        long = name in SINGLE
        if not long:
            timed(known[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(known[name], spark, sf_dir) for _ in range(1 if long else repeats)), 3)
        print(f"{name:28s} {seconds[name]:7.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
