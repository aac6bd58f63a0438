"""Re-validate periods as their data arrives (Structured Streaming).

Late-arriving partitions are handled by re-running the affected periods and
appending the new results to the run log; the older results stay as history.
This job does that continuously: the dashboard table's folder is a file
stream, each micro-batch yields the set of periods it touched (a DataFrame,
never collected), and ``foreachBatch`` runs the whole suite for exactly those
periods against the full tables and appends the log rows.

``trigger(availableNow=True)`` gives the scheduled-job form (process what is
new, then stop); a processing-time trigger keeps it running.  Progress is
kept in a checkpoint under the shared scratch folder, so a restarted job
resumes after the last committed batch.  A batch replayed after a failure is
a genuine re-run and is appended again with its own run timestamp.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyho.plans import history as H
from tallyho.plans.items import append_items, item_rows
from tallyho.plans.suite import Suite
from tallyho.session import scratch_path


def _utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="seconds")


def rerun_batch(
    spark: SparkSession,
    registry: dict,
    batch: DataFrame,
    period_of: Column,
    log_path: str,
    run_timestamp: str | None = None,
    run_key: str | None = None,
    items_path: str | None = None,
) -> None:
    """Validate every period present in ``batch`` and append the results, and their items if asked for, to the logs."""
    touched = batch.select(period_of.alias("run_week")).where("run_week IS NOT NULL").distinct()
    suite = Suite(spark, registry, runs=touched)
    ts = run_timestamp or _utc_now()
    if items_path:
        rows = item_rows(suite.items(), ts)
        append_items(rows if run_key is None else rows.withColumn("run_id", F.concat_ws("_", "dashboard", "run_week", F.lit(run_key))), items_path)
    H.append_log(H.log_rows(suite.check_results(), ts, run_key=run_key), log_path)


def start_rerun_stream(
    spark: SparkSession,
    registry_for_batch: Callable[[], dict] | dict,
    arrivals: DataFrame,
    period_of: Column,
    log_path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    run_timestamp: str | None = None,
    stream: str = "arrivals",
    items_path: str | None = None,
) -> StreamingQuery:
    """Start the re-validation stream over ``arrivals`` (a streaming DataFrame).

    Without ``run_timestamp`` a run's id ends in the stream's name and the
    micro-batch's number, so a micro-batch that is replayed after a failure
    replaces its own rows instead of adding to them, whenever it is replayed.
    """

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        reg = registry_for_batch() if callable(registry_for_batch) else registry_for_batch
        rerun_batch(spark, reg, batch, period_of, log_path, run_timestamp, None if run_timestamp else f"{stream}-{epoch_id}", items_path)

    writer = arrivals.writeStream.foreachBatch(on_batch).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "rerun-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
