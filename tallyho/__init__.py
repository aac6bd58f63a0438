"""tallyho: Spark-native checks of a reporting table against its source and its history."""

from tallyho.config import CheckSpec, load_registry, normalize
from tallyho.plans.history import append_log, append_log_table, drift_frequency, latest_run, latest_run_summary, log_rows, read_log
from tallyho.plans.report import fail_gate, failed_runs, report_headers, report_lines, triage_context
from tallyho.plans.suite import Suite, run_suites, summarize
from tallyho.plans.validate import validate

__all__ = [
    "CheckSpec",
    "Suite",
    "append_log",
    "append_log_table",
    "drift_frequency",
    "fail_gate",
    "failed_runs",
    "latest_run",
    "latest_run_summary",
    "load_registry",
    "log_rows",
    "normalize",
    "read_log",
    "report_headers",
    "report_lines",
    "run_suites",
    "summarize",
    "triage_context",
    "validate",
]
