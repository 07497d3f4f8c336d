"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the number of local cores. Each query runs once to warm up and
then BENCH_REPEAT times (default 2); the best run counts. Results go to Spark's
no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barline.session import build_session  # noqa: E402
from suite import queries  # noqa: E402

HEADLINE = (
    "M6_backfill_scores", "M6_backfill_by_user", "M3_score", "M3_score_batches", "M4_score_file", "T3_select_incremental",
    "J3_consistency_gate", "J10_nearest_ts", "W1_latest_features", "W2_forward_return", "W4_obv", "W5_rank_first_by_flag",
    "W10_calibration_lines", "W11_lookback", "W13_hourly_continuity", "W20_indicators", "W23_recompute_features",
    "A7_diff_stats_nonzero_lines", "A10_resample_bars", "C3_compare_lines_orders", "C4_compare_maps", "C13_compare_batch",
)


def run(fn, spark, sf: str) -> float:
    start = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    known, times = queries(), {}
    for name in names:
        run(known[name], spark, sf)
        times[name] = round(min(run(known[name], spark, sf) for _ in range(repeat)), 3)
    rows = known["M6_backfill_by_user"](spark, sf).count()
    backfill = times.get("M6_backfill_by_user")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus), "shuffle_partitions": int(cpus),
        "backfill_bars": rows, "backfill_bars_per_sec": round(rows / backfill, 1) if backfill else None,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
