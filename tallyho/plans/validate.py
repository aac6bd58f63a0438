"""The scheduled run in one call: run week → suite → log → gate.

Equivalent of the weekly job: resolve the period to validate (a parameter,
else the latest label dated on or before today in the date dimension), run
every configured check, append the results to the run log, and fail when a
check failed.  Reporting and triage frames are returned for the caller to
show or send.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyho.config import load_registry
from tallyho.plans import history as H
from tallyho.plans import report as R
from tallyho.plans.items import append_items, item_rows
from tallyho.plans.periods import run_week_for
from tallyho.plans.suite import Suite
from tallyho.sources.tables import resolve


@dataclass
class RunOutput:
    run_week: str | None
    results: DataFrame
    summary: DataFrame
    report_headers: DataFrame
    report_lines: DataFrame
    triage_context: DataFrame
    items: DataFrame


def validate(
    spark: SparkSession,
    registry: dict | str,
    run_week: str | None = None,
    dim_date=None,
    today: str | None = None,
    log_path: str | None = None,
    log_table: str | None = None,
    run_timestamp: str | None = None,
    gate: bool = True,
    items_path: str | None = None,
    triage: DataFrame | None = None,
) -> RunOutput:
    reg = load_registry(registry) if isinstance(registry, str) else registry
    if not run_week:
        if dim_date is None:
            raise ValueError("give run_week or a date dimension to resolve it from")
        today = today or _dt.date.today().isoformat()
        run_week = run_week_for(resolve(spark, dim_date), None, today)
    if run_week is None:
        raise ValueError("no period in the date dimension on or before today")
    suite = Suite(spark, reg, runs=[run_week])
    results = suite.check_results()
    summary = suite.run_summary(results)
    ts = run_timestamp or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")
    if log_path or log_table:
        rows = H.log_rows(results, ts, triage)
        if log_path:
            H.append_log(rows, log_path)
        if log_table:
            H.append_log_table(rows, log_table)
    items = suite.items()
    if items_path:
        append_items(item_rows(items, ts), items_path)
    out = RunOutput(run_week, results, summary, R.report_headers(summary, ts, triage), R.report_lines(results), R.triage_context(results), items)
    if gate:
        R.fail_gate(summary)
    return out
