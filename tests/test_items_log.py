"""Item log, replay-safe appends, evolving log tables, report texts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyho.plans import history as H
from tallyho.plans import items as I
from tallyho.plans import report as R
from tallyho.plans.suite import Suite
from tallyho.session import scratch_path
from tallyho.streaming.rerun import rerun_batch, start_rerun_stream
from tests.test_history_report import results, run

FACTS = "wk string, shop string, spend decimal(18,2)"


def registry(dash, src):
    return {
        "dashboard": "shops",
        "dashboard_table": dash,
        "source_table": src,
        "date_column": "wk",
        "metrics": [{"name": "spend", "tolerance_pct": 5, "checks": ["reconciliation"]}],
        "dimensions": [{"name": "shop", "completeness_check": True, "required_values": ["north", "south", "o'hare"]}],
        "checks": {"parts_sum": {"pivot_columns": ["shop"]}},
    }


def shops(spark):
    amounts = [("2024-07", "north", "100.00", "100.00"), ("2024-07", "zeta", "50.00", "10.00"), ("2024-07", None, "20.00", "40.00"), ("2024-07", "alpha", "1234.50", "0.00")]
    src = spark.createDataFrame([(w, s, Decimal(a)) for w, s, a, _ in amounts], FACTS)
    dash = spark.createDataFrame([(w, s, Decimal(b)) for w, s, _, b in amounts], FACTS)
    return dash, src


def test_items_are_numbered_in_order(spark):
    suite = Suite(spark, registry(*shops(spark)))
    rows = {(r["item_kind"], r["position"]): r for r in suite.items().collect()}
    assert [rows["failing_group", i]["item"] for i in (1, 2, 3)] == ["alpha", "zeta", None]
    assert rows["failing_group", 1]["text"] == "alpha: expected 1,235, got 0 (100.0%)"
    assert rows["failing_group", 3]["text"] == "None: expected 20, got 40 (100.0%)"
    assert [rows["missing_value", i]["item"] for i in (1, 2)] == ["south", "o'hare"]
    assert [rows["new_value", i]["item"] for i in (1, 2, 3)] == ["alpha", "zeta", None] and len(rows) == 8
    detail = {r["check_name"]: r["detail"] for r in suite.check_results().collect()}
    assert detail["completeness"].startswith("Missing shop values: ['south', 'o'hare']")


@pytest.mark.parametrize("parts", [1, 7])
def test_numbering_does_not_depend_on_the_parts_of_the_sort(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        src = spark.range(3000).selectExpr("'2024-07' AS wk", "CAST(id AS STRING) AS shop", "CAST(1 AS DECIMAL(18,2)) AS spend")
        reg = registry(src.withColumn("spend", F.expr("CAST(2 AS DECIMAL(18,2))")), src)
        items = Suite(spark, reg).items().where("item_kind = 'failing_group'")
        got = [(r["position"], r["item"]) for r in items.collect()]
        texts = I.item_texts(items, chunk=1000).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == list(enumerate(sorted(map(str, range(3000))), 1))
    assert sorted((t["chunk"], t["n_items"], len(t["text"].split("; "))) for t in texts) == [(c, 1000, 1000) for c in range(3)]


def test_item_log_replaces_a_run_that_is_written_again(spark):
    path = scratch_path(spark, "test-items")
    items = Suite(spark, registry(*shops(spark))).items()
    for ts in ("2024-02-20T06:00:00", "2024-02-20T06:00:00", "2024-02-21T06:00:00"):
        I.append_items(I.item_rows(items, ts), path)
    back = I.read_items(spark, path)
    assert back.groupBy("run_id").count().select("count").collect() == [(8,), (8,)]
    assert {r["run_id"] for r in back.collect()} == {"shops_2024-07_2024-02-20T06:00:00", "shops_2024-07_2024-02-21T06:00:00"}


def test_no_itemising_check_gives_no_items(spark):
    dash, src = shops(spark)
    reg = {"dashboard": "d", "dashboard_table": dash, "source_table": src, "date_column": "wk", "metrics": [{"name": "spend"}]}
    items = Suite(spark, reg).items()
    assert items.columns == I.ITEM_COLUMNS and items.isEmpty()


def test_a_repeated_write_of_a_run_adds_no_rows(spark):
    path = scratch_path(spark, "test-log")
    for week, fail in (("2021-14", True), ("2021-15", True), ("2021-14", True)):
        H.append_log(H.log_rows(run(spark, week, fail), "2021-04-12T05:30:00"), path)
    H.append_log(H.log_rows(run(spark, "2021-14", False), "2021-04-13T05:30:00"), path)
    log = H.read_log(spark, path)
    assert sorted((r["run_id"], r["count"]) for r in log.groupBy("run_id").count().collect()) == [
        ("sales_weekly_2021-14_2021-04-12T05:30:00", 2),
        ("sales_weekly_2021-14_2021-04-13T05:30:00", 2),
        ("sales_weekly_2021-15_2021-04-12T05:30:00", 2),
    ]
    assert log.columns == H.LOG_COLUMNS


def test_a_micro_batch_that_failed_after_its_write_is_replayed_without_a_trace(spark):
    landing, log_path, items_path, checkpoint = (scratch_path(spark, f"test-replay-{x}") for x in ("landing", "log", "items", "ckpt"))
    dash, src = shops(spark)
    dash.write.parquet(landing)

    def reg():
        return registry(spark.read.schema(FACTS).parquet(landing), src)

    def stream(on_log=None):
        q = start_rerun_stream(spark, reg, spark.readStream.schema(FACTS).parquet(landing), F.col("wk"), log_path, checkpoint=checkpoint, items_path=items_path)
        return q

    real = H.append_log
    try:
        def write_then_fail(df, path):
            real(df, path)
            raise RuntimeError("lost before the micro-batch was committed")

        H.append_log = write_then_fail
        q = stream()
        with pytest.raises(Exception, match="lost before"):
            q.awaitTermination()
    finally:
        H.append_log = real
    first = H.read_log(spark, log_path)
    n, ids = first.count(), {r["run_id"] for r in first.collect()}
    assert n > 0 and ids == {"shops_2024-07_arrivals-0"}
    q = stream()
    q.awaitTermination()
    assert q.exception() is None
    again = H.read_log(spark, log_path)
    assert again.count() == n and {r["run_id"] for r in again.collect()} == ids
    assert I.read_items(spark, items_path).groupBy("run_id").count().collect() == [("shops_2024-07_arrivals-0", 8)]
    rerun_batch(spark, reg(), dash, F.col("wk"), log_path, run_key="arrivals-1")  # the next micro-batch is a run of its own
    assert H.read_log(spark, log_path).count() == 2 * n


def test_a_log_table_takes_new_columns_and_replaces_a_repeated_run(spark):
    table = "test_evolving_log"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        one = H.log_rows(run(spark, "2021-14"), "2021-04-12T05:30:00")
        H.append_log_table(one, table)
        H.append_log_table(H.log_rows(run(spark, "2021-15"), "2021-04-19T05:30:00").withColumn("owner", F.lit("ops")).withColumn("n", F.lit(3)), table)
        H.append_log_table(H.log_rows(run(spark, "2021-16"), "2021-04-26T05:30:00"), table)
        H.append_log_table(one.withColumn("owner", F.lit("night")), table)
        log = spark.table(table)
        assert {(r["run_week"], r["owner"], r["n"], r["count"]) for r in log.groupBy("run_week", "owner", "n").count().collect()} == {("2021-14", "night", None, 2), ("2021-15", "ops", 3, 2), ("2021-16", None, None, 2)}
        assert H.latest_run(log).count() == 6
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_report_texts(spark):
    res = results(
        spark,
        [
            ("d", "2024-07", 1, "reconciliation", "spend", "FAIL", "P2", "5200.0", "4810.0", 5200.0, 4810.0, -390.0, 2.5, "abs", "Gap: 7.50%"),
            ("d", "2024-07", 2, "trend_sanity", "spend", "DRIFT", "P3", "100.0", "175.4", 100.0, 175.4, 75.4, 50.0, "pct", "up"),
            ("d", "2024-07", 3, "completeness", "shop_completeness", "DRIFT", "P3", "3", None, 3.0, None, None, None, None, "Missing"),
        ],
    )
    lines = [r["line"] for r in R.report_lines(res).orderBy("check_seq").collect()]
    assert "Gap: -390   Tolerance: ±2.5%" in lines[0] and "Gap: +75.4%   Tolerance: ±50.0%" in lines[1] and "Got: None | Missing" in lines[2]
    context = R.triage_context(res).collect()[0]["context"]
    assert "expected: 5200.0  |  got: 4810.0" in context and "detail: up" in context and "got: None" in context
    summary = spark.createDataFrame([("d", "2024-07", 3, 0, 2, 1, "FAIL"), ("d", "2024-08", 3, 3, 0, 0, "PASS")], "dashboard string, run_week string, total long, pass long, drift long, fail long, overall_status string")
    triage = spark.createDataFrame([("d", "2024-07", "One shop did not report.")], "dashboard string, run_week string, triage_analysis string")
    headers = {r["run_week"]: r for r in R.report_headers(summary, "2024-02-20T06:00:00", triage).collect()}
    assert headers["2024-07"]["triage_analysis"] == "One shop did not report." and headers["2024-08"]["triage_analysis"] is None
    assert {r["run_timestamp"] for r in headers.values()} == {"2024-02-20T06:00:00"}


def test_quarters_of_day_and_week_labels(spark):
    labels = {"2024-07-01": "2024-Q3", "2024-06-30": "2024-Q2", "2024-12-31": "2024-Q4", "2024-01": "2024-Q1", "2024-14": "2024-Q2", "2024-53": "2024-Q4"}
    rows = spark.createDataFrame([(x,) for x in labels], "label string").select("label", H.quarter_of(F.col("label")).alias("q")).collect()
    assert {r["label"]: r["q"] for r in rows} == labels
