"""Named queries over the driver's test tables (each returns a lazy DataFrame).

Every query reads whole tables through the fixtures of ``tallyho.sources.
fixtures`` and runs the library's plans; the column names match the SQL in
``tallyho.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.functions.periods import week_label
from tallyho.functions.scoring import severity
from tallyho.plans import history as H
from tallyho.plans import items as I
from tallyho.plans import periods as P
from tallyho.plans import report as R
from tallyho.plans.stored import StoredBase
from tallyho.plans.suite import Suite, run_suites
from tallyho.session import scratch_path
from tallyho.sources import fixtures as X
from tallyho.streaming import start_rerun_stream

RES = ["run_week", "check_seq", "check_name", "metric", "status", "severity", "expected_num", "actual_num", "gap", "tolerance"]

# Fixed run timestamps of the two logged runs (F4).
LOG_TS_1 = "2024-02-05T06:00:00"
LOG_TS_2 = "2024-02-05T07:00:00"

# Fixed as-of dates for run-week resolution: mid-range, before the first date, after the last.
AS_OF = ["1995-06-15", "1990-01-01", "1999-12-31"]

EXPECTED_CHANGES = [
    {"dimension": "platform", "value": "signup", "change": "disappears", "effective_week": "2024-02"},
    {"dimension": "platform", "value": "beta", "change": "appears", "effective_week": "2024-02"},
]

REVERSED_CHANGES = [
    {"dimension": "platform", "value": "signup", "change": "disappears", "effective_week": "2024-01"},
    {"dimension": "platform", "value": "signup", "change": "appears", "effective_week": "2024-02"},
    {"dimension": "platform", "value": "beta", "change": "appears", "effective_week": "2024-01"},
    {"dimension": "platform", "value": "beta", "change": "disappears", "effective_week": "2024-02"},
    {"dimension": "platform", "value": "click", "change": "disappears", "effective_week": "2024-03"},
]


def _res(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*[severity(F.col("status")).alias("severity") if c == "severity" else F.col(c) for c in RES], *extra)


def _f1(spark, sf, only=None, **kw) -> Suite:
    return Suite(spark, X.events_registry(spark, sf, **kw), only=only)


def _f2(spark, sf, only=None, **kw) -> Suite:
    return Suite(spark, X.lineitem_registry(spark, sf, **kw), only=only)


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return _res(_f1(spark, sf, ("reconciliation",)).reconciliation(), "gap_pct")


def verify_totals(spark: SparkSession, sf: str) -> DataFrame:
    return P.verify_totals(
        spark, X.events_dashboard(spark, sf), X.events_source(spark, sf), "wk", ["spend", "interactions"]
    )


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    f = _f1(spark, sf, ("freshness",)).freshness()
    return f.select("run_week", "check_name", "metric", "status", severity(F.col("status")).alias("severity"), "expected", "actual")


def resolve_run_week(spark: SparkSession, sf: str) -> DataFrame:
    return P.resolve_run_week(X.orders_date_dim(spark, sf), AS_OF)


def parts_sum(spark: SparkSession, sf: str) -> DataFrame:
    checks = dict(X.events_registry(spark, sf)["checks"])
    checks["parts_sum"] = {"enabled": True, "pivot_column": "platform"}
    return _res(_f1(spark, sf, ("parts_sum",), checks=checks).parts_sum(), "n_failing")


def parts_sum_multi_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return _res(_f1(spark, sf, ("parts_sum",)).parts_sum(), "n_failing")


def parts_sum_detail(spark: SparkSession, sf: str) -> DataFrame:
    return _f1(spark, sf, ("parts_sum",)).parts_sum_detail().drop("dashboard")


def trend_sanity(spark: SparkSession, sf: str) -> DataFrame:
    return _res(_f1(spark, sf, ("trend_sanity",)).trend_sanity(), "baseline", "current", "change_pct", "n_weeks")


def trend_sanity_limit20(spark: SparkSession, sf: str) -> DataFrame:
    checks = dict(X.events_registry(spark, sf)["checks"])
    checks["trend_sanity"] = {"enabled": True, "max_wow_change_pct": 20.0}
    return _res(_f1(spark, sf, ("trend_sanity",), checks=checks).trend_sanity(), "baseline", "current", "change_pct", "n_weeks")


def weekly_totals(spark: SparkSession, sf: str) -> DataFrame:
    return P.weekly_totals(_f1(spark, sf, ("trend_sanity",)).base).drop("dashboard")


def prev_week(spark: SparkSession, sf: str) -> DataFrame:
    labels = X.lineitem_facts(spark, sf).select(F.col("wk").alias("run_week")).distinct()
    return P.previous_labels(labels, 1).select("run_week", "prev_week")


def lookback_weeks(spark: SparkSession, sf: str) -> DataFrame:
    labels = X.lineitem_facts(spark, sf).select(F.col("wk").alias("run_week")).distinct()
    return P.previous_labels(labels, 4)


def trend_backfill(spark: SparkSession, sf: str) -> DataFrame:
    s = _f2(spark, sf, ("trend_sanity",))
    return P.trend_window(s.base, s.spec.lookback, 20.0).drop("dashboard")


def trend_backfill_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The trend of every week, of the whole table and of each segment."""
    s = _f2(spark, sf, ("trend_sanity", "parts_sum"))
    return P.trend_segments(s.base, s.spec.lookback, 20.0, "segment").drop("dashboard")


def trend_backfill_join(spark: SparkSession, sf: str) -> DataFrame:
    """Same answers as ``trend_backfill`` through the lookback-label join (J5)."""
    t = _f2(spark, sf, ("trend_sanity",)).trend_sanity()
    return t.select("run_week", "metric", "baseline", "current", "change_pct", "n_weeks", "status")


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    return _res(_f1(spark, sf, ("completeness",)).completeness(), "n_missing", "n_new", "missing_values")


def missing_values(spark: SparkSession, sf: str) -> DataFrame:
    missing, _ = _f1(spark, sf, ("completeness",)).completeness_values()
    return missing.select("run_week", "dimension", "value")


def new_values(spark: SparkSession, sf: str) -> DataFrame:
    _, new = _f1(spark, sf, ("completeness",)).completeness_values()
    return new.select("run_week", "dimension", "value")


def completeness_expected_changes(spark: SparkSession, sf: str) -> DataFrame:
    s = _f1(spark, sf, ("completeness",), expected_changes=EXPECTED_CHANGES)
    return _res(s.completeness(), "n_missing", "n_new", "missing_values")


def completeness_change_reversed(spark: SparkSession, sf: str) -> DataFrame:
    """A scheduled disappearance that a later change takes back: the value is required again."""
    s = _f1(spark, sf, ("completeness",), expected_changes=REVERSED_CHANGES)
    return _res(s.completeness(), "n_missing", "n_new", "missing_values")


def sanity_range(spark: SparkSession, sf: str) -> DataFrame:
    return _res(_f1(spark, sf, ("sanity_range",)).sanity_range(), "n_rows", "violations")


def suite_results(spark: SparkSession, sf: str) -> DataFrame:
    return _f1(spark, sf).check_results().select(*RES)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _f1(spark, sf).run_summary()


def suite_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return _f2(spark, sf).check_results().select(*RES)


def suite_row_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _f2(spark, sf, row_filter="pillar = 'F'").check_results().select(*RES)


def suite_multi_dashboard(spark: SparkSession, sf: str) -> DataFrame:
    _, summary = run_suites(spark, [X.events_registry(spark, sf), X.lineitem_registry(spark, sf)])
    return summary


def _daily_registry(spark: SparkSession, sf: str) -> dict:
    facts = X.orders_daily(spark, sf)
    return {
        "dashboard": "orders_daily",
        "dashboard_table": facts,
        "source_table": facts,
        "date_column": "order_date",
        "grain": "day",
        "lookback_weeks": 7,
        "metrics": [{"name": "total_price", "checks": ["trend_sanity"]}],
        "checks": {"freshness": {"enabled": False}, "trend_sanity": {"max_wow_change_pct": 50.0}},
    }


def trend_daily(spark: SparkSession, sf: str) -> DataFrame:
    t = Suite(spark, _daily_registry(spark, sf)).trend_sanity()
    return t.select(F.col("run_week").alias("day"), "baseline", "current", "change_pct", "n_weeks", "status")


# ── run log (F4: the F1 suite logged twice) ─────────────────────────────────


def _logged(spark: SparkSession, sf: str) -> DataFrame:
    def registry(tol: float) -> dict:
        reg = X.events_registry(spark, sf)
        reg["metrics"] = [dict(m, tolerance_pct=tol) for m in reg["metrics"]]
        return reg

    path = scratch_path(spark, "runlog")
    first = Suite(spark, registry(1.0))
    second = Suite(spark, registry(5.0), base=first.base)  # other tolerances, the same aggregate
    for ts, suite in ((LOG_TS_1, first), (LOG_TS_2, second)):
        H.append_log(H.log_rows(suite.check_results(), ts), path)
    return H.read_log(spark, path)


def log_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = H.log_rows(_f1(spark, sf).check_results(), LOG_TS_1)
    return rows.drop("detail")


def log_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return _logged(spark, sf).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    return H.latest_run(_logged(spark, sf)).select("dashboard", "run_week", "run_timestamp", "check_name", "metric", "status")


def latest_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return H.latest_run_summary(_logged(spark, sf))


def drift_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return H.drift_frequency(_logged(spark, sf))


def rerun_on_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive as a file stream; every week they touch is re-validated and logged."""
    events = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    arrivals = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    log_path = scratch_path(spark, "rerun-log")
    q = start_rerun_stream(
        spark, lambda: X.events_registry(spark, sf), arrivals, week_label(F.col("ts")), log_path, run_timestamp=LOG_TS_1
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return H.read_log(spark, log_path).drop("detail")


def rerun_late_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Late files: the events land in two loads, and after the first was validated only the second's weeks are due."""
    landing = scratch_path(spark, "landing")
    events = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    late = F.expr("event_id % 50 = 7") & week_label(F.col("ts")).isin("2024-03", "2024-04")
    reg = X.events_registry(spark, sf, dashboard_table=landing, source_table=landing)
    folder = scratch_path(spark, "stored-base")
    for load in (~late, late):
        events.where(load).write.mode("append").parquet(landing)
        stored = StoredBase(spark, reg, folder, {"dash": X.dashboard_facts, "src": X.source_facts})
        stored.refresh()
        suite = stored.suite()
        stored.finished()
    return suite.check_results().select(*RES)


def suite_single_week(spark: SparkSession, sf: str) -> DataFrame:
    """The scheduled form: one literal week, its filters pushed to both scans."""
    return Suite(spark, X.events_registry(spark, sf), runs=["2024-03"]).check_results().select(*RES)


def validate_log(spark: SparkSession, sf: str) -> DataFrame:
    """The scheduled run from a date dimension to the log, read back."""
    from tallyho.plans.validate import validate

    days = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select(F.to_date("ts").alias("full_date")).distinct()
    dim = days.withColumn("fiscal_yr_and_wk_desc", week_label(F.col("full_date")))
    log_path = scratch_path(spark, "validate-log")
    validate(spark, X.events_registry(spark, sf), dim_date=dim, today="2024-01-20", log_path=log_path, run_timestamp=LOG_TS_1, gate=False)
    return H.read_log(spark, log_path).drop("detail")


# ── report frames ───────────────────────────────────────────────────────────


def drift_frequency_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Day labels fall into their calendar quarters."""
    results = Suite(spark, _daily_registry(spark, sf)).check_results()
    return H.drift_frequency(H.log_rows(results, LOG_TS_1))


def report_headers(spark: SparkSession, sf: str) -> DataFrame:
    return R.report_headers(_f1(spark, sf).run_summary()).drop("counts")


def report_lines(spark: SparkSession, sf: str) -> DataFrame:
    return R.report_lines(_f1(spark, sf).check_results()).drop("line", "dashboard", "gap_unit")


def report_line_text(spark: SparkSession, sf: str) -> DataFrame:
    return R.report_lines(_f1(spark, sf).check_results()).select("run_week", "check_seq", "line")


def result_details(spark: SparkSession, sf: str) -> DataFrame:
    return _f1(spark, sf).check_results().select("run_week", "check_seq", "detail")


def run_items(spark: SparkSession, sf: str) -> DataFrame:
    """Both checks' items, written to the item log under their runs and read back."""
    path = scratch_path(spark, "item-log")
    I.append_items(I.item_rows(_f1(spark, sf, ("parts_sum", "completeness")).items(), LOG_TS_1), path)
    return I.read_items(spark, path).drop("run_id", "run_timestamp", "dashboard")


def run_item_texts(spark: SparkSession, sf: str) -> DataFrame:
    return I.item_texts(_f1(spark, sf, ("parts_sum", "completeness")).items(), chunk=2).drop("dashboard")


def triage_context(spark: SparkSession, sf: str) -> DataFrame:
    return R.triage_context(_f1(spark, sf).check_results()).drop("dashboard")


def failed_runs(spark: SparkSession, sf: str) -> DataFrame:
    return R.failed_runs(_f1(spark, sf).run_summary())


QUERIES = {
    "reconciliation": reconciliation,
    "verify_totals": verify_totals,
    "freshness": freshness,
    "resolve_run_week": resolve_run_week,
    "parts_sum": parts_sum,
    "parts_sum_multi_pivot": parts_sum_multi_pivot,
    "parts_sum_detail": parts_sum_detail,
    "trend_sanity": trend_sanity,
    "trend_sanity_limit20": trend_sanity_limit20,
    "weekly_totals": weekly_totals,
    "prev_week": prev_week,
    "lookback_weeks": lookback_weeks,
    "trend_backfill": trend_backfill,
    "trend_backfill_join": trend_backfill_join,
    "trend_backfill_segments": trend_backfill_segments,
    "completeness": completeness,
    "missing_values": missing_values,
    "new_values": new_values,
    "completeness_expected_changes": completeness_expected_changes,
    "completeness_change_reversed": completeness_change_reversed,
    "sanity_range": sanity_range,
    "suite_results": suite_results,
    "run_summary": run_summary,
    "suite_single_week": suite_single_week,
    "rerun_late_weeks": rerun_late_weeks,
    "validate_log": validate_log,
    "suite_backfill": suite_backfill,
    "suite_row_filter": suite_row_filter,
    "suite_multi_dashboard": suite_multi_dashboard,
    "trend_daily": trend_daily,
    "log_rows": log_rows,
    "rerun_on_arrival": rerun_on_arrival,
    "log_append_roundtrip": log_append_roundtrip,
    "latest_run": latest_run,
    "latest_run_summary": latest_run_summary,
    "drift_frequency": drift_frequency,
    "drift_frequency_daily": drift_frequency_daily,
    "run_items": run_items,
    "run_item_texts": run_item_texts,
    "result_details": result_details,
    "report_line_text": report_line_text,
    "report_headers": report_headers,
    "report_lines": report_lines,
    "triage_context": triage_context,
    "failed_runs": failed_runs,
}
