"""Report, triage and gate outputs as DataFrames.

Message posting and model calls are side effects left to the caller; what is
built here are the rows they would carry: one header per run, one line per
non-PASS check, one triage context per non-PASS run, and the failed runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.functions.scoring import FAIL, PASS, float_text_sql


def report_headers(summary: DataFrame, run_timestamp: str | None = None, triage: DataFrame | None = None) -> DataFrame:
    """One row per run: counts, overall status, the headline text, and the run's time and analysis where given.

    ``triage`` has (dashboard, run_week, triage_analysis); a run without one has NULL.
    """
    headline = F.when(
        F.col("overall_status") == PASS,
        F.format_string("%s — %d/%d checks PASS", F.col("dashboard"), F.col("total"), F.col("total")),
    ).otherwise(F.format_string("%s — %d FAIL on %s", F.col("dashboard"), F.col("fail"), F.col("run_week")))
    counts = F.format_string("%d FAIL  ·  %d DRIFT  ·  %d PASS", F.col("fail"), F.col("drift"), F.col("pass"))
    rows = summary.select("dashboard", "run_week", "total", "pass", "drift", "fail", "overall_status", headline.alias("headline"), counts.alias("counts"))
    if triage is not None:
        rows = rows.join(triage.select("dashboard", "run_week", "triage_analysis"), ["dashboard", "run_week"], "left")
    if run_timestamp is not None:
        rows = rows.withColumn("run_timestamp", F.lit(run_timestamp))
    return rows


def _line(results: DataFrame) -> F.Column:
    gap_text = F.when(
        F.col("gap").isNotNull() & F.col("tolerance").isNotNull(),
        F.concat(
            # A trend's gap is a percentage, others are amounts.
            F.when(F.col("gap_unit") == "pct", F.format_string("   Gap: %+.1f%%", F.col("gap"))).otherwise(F.format_string("   Gap: %+,.0f", F.col("gap"))),
            F.format_string("   Tolerance: ±%s%%", F.expr(float_text_sql("tolerance"))),
        ),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("["),
        F.col("check_name"),
        F.lit("] "),
        F.col("metric"),
        F.lit(": "),
        F.col("status"),
        F.when(F.col("severity").isNotNull(), F.concat(F.lit(" (severity "), F.col("severity"), F.lit(")"))).otherwise(F.lit("")),
        F.lit(" | Expected: "),
        F.coalesce(F.col("expected"), F.lit("None")),
        F.lit("   Got: "),
        F.coalesce(F.col("actual"), F.lit("None")),
        gap_text,
        F.lit(" | "),
        F.col("detail"),
    )


def report_lines(results: DataFrame) -> DataFrame:
    """One row per FAIL or DRIFT check, with its rendered line."""
    return results.where(F.col("status") != PASS).select(
        "dashboard", "run_week", "check_seq", "check_name", "metric", "status", "severity", "gap_unit", _line(results).alias("line")
    )


def triage_context(results: DataFrame) -> DataFrame:
    """One row per non-PASS run: its failing checks as one ordered text, each with what was expected, what came, and the detail.

    The list per run is bounded by the number of configured checks.
    """
    lines = results.where(F.col("status") != PASS).select(
        "dashboard",
        "run_week",
        F.struct(
            F.col("check_seq"),
            F.format_string(
                "check: %s  |  metric: %s  |  status: %s\n  expected: %s  |  got: %s\n  detail: %s",
                *(F.coalesce(F.col(c), F.lit("None")) for c in ("check_name", "metric", "status", "expected", "actual", "detail")),
            ).alias("text"),
        ).alias("item"),
    )
    return lines.groupBy("dashboard", "run_week").agg(
        F.count(F.lit(1)).alias("n_failing"),
        F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x["text"]), "\n").alias("context"),
    )


def failed_runs(summary: DataFrame) -> DataFrame:
    """Runs that would fail the scheduled job (DRIFT does not)."""
    return summary.where(F.col("fail") > 0).select("dashboard", "run_week", F.col("fail").alias("n_fail"))


def fail_gate(summary: DataFrame) -> None:
    """Raise when any run has a FAIL check (one small action)."""
    bad = failed_runs(summary).orderBy("dashboard", "run_week").take(1)
    if bad:
        r = bad[0]
        raise RuntimeError(f"validation {FAIL}: {r['n_fail']} failures on {r['dashboard']} / {r['run_week']}")
