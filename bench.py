"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``value`` is the total wall time of the headline queries (each fully
collected).  ``per_check_style`` times the same F1 validation done the way the
reference runs it: one collected scalar/grouped aggregate per check, per week,
sequentially; ``fused_suite`` is our whole F1 suite for all weeks.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tallyho.queries import QUERIES  # noqa: E402
from tallyho.session import build_session  # noqa: E402
from tallyho.sources import fixtures as X  # noqa: E402

HEADLINE = [
    "suite_results",
    "run_summary",
    "suite_backfill",
    "suite_row_filter",
    "trend_backfill",
    "trend_daily",
    "parts_sum_detail",
    "completeness",
    "verify_totals",
    "resolve_run_week",
    "latest_run",
]


# The scheduled form, one week; warm, the median of three.
ONE_WEEK = ["suite_single_week", "validate_log"]


def per_check_style(spark, sf: str, weeks: tuple[str, ...] = ("2024-01", "2024-02", "2024-03", "2024-04", "2024-05")) -> float:
    """One collected aggregate per check and week, as a single-query-per-check engine would run."""
    dash = X.events_dashboard(spark, sf).where("data_type <> 'Budget' OR data_type IS NULL")
    src = X.events_source(spark, sf).where("data_type <> 'Budget' OR data_type IS NULL")
    t = time.time()
    dash.agg(F.max("wk")).collect()
    for w in weeks:
        prev = [f"2024-{int(w[-2:]) - i:02d}" for i in range(1, 5)]
        for m in ("spend", "interactions"):
            dash.where(F.col("wk") == w).agg(F.sum(m)).collect()
            src.where(F.col("wk") == w).agg(F.sum(m)).collect()
            dash.where(F.col("wk") == w).agg(F.sum(m)).collect()
            dash.where(F.col("wk").isin(prev)).groupBy("wk").agg(F.sum(m)).collect()
            for p in ("platform", "pillar"):
                dash.where(F.col("wk") == w).groupBy(p).agg(F.sum(m)).collect()
                src.where(F.col("wk") == w).groupBy(p).agg(F.sum(m)).collect()
        dash.where(F.col("wk") == w).select("platform").distinct().collect()
        dash.where(F.col("wk").isin(prev)).select("platform").distinct().collect()
        dash.where(F.col("wk") == w).agg(F.count(F.lit(1)), F.count_if(F.expr("spend < 0"))).collect()
    return time.time() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # JVM warm-up on the smallest scale (not timed).
    QUERIES["suite_results"](spark, "/root/testdata/sf0.001").collect()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        t = time.time()
        n = len(QUERIES[name](spark, sf).collect())
        times[name] = round(time.time() - t, 3)
        rows[name] = n
    t = time.time()
    QUERIES["suite_results"](spark, sf).collect()
    fused = round(time.time() - t, 3)
    baseline_style = round(per_check_style(spark, sf), 3)

    def thrice(run) -> float:
        took = []
        for _ in range(3):
            t = time.time()
            run()
            took.append(time.time() - t)
        return round(median(took), 3)

    one_week = {name: thrice(lambda q=QUERIES[name]: q(spark, sf).collect()) for name in ONE_WEEK}
    one_week["per_check_style"] = thrice(lambda: per_check_style(spark, sf, ("2024-03",)))
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "fused_suite_f1_all_weeks": fused,
        "per_check_style_f1_all_weeks": baseline_style,
        "one_week_warm_median_of_3": one_week,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
