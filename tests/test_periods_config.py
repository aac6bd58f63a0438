"""Week arithmetic and registry gating rules."""

from pyspark.sql import functions as F

import pytest

from tallyho.config import normalize
from tallyho.functions.periods import DayGrain, WeekGrain, lookback_labels_py


def _labels(spark, col_expr, labels):
    df = spark.createDataFrame([(w,) for w in labels], "w string")
    return [r[0] for r in df.select(col_expr(F.col("w")).alias("x")).collect()]


def test_prev_week_rolls_over_years_and_week_53(spark):
    cases = {"2019-33": "2019-32", "2020-10": "2020-09", "2021-01": "2020-52", "1998-53": "1998-52", "1999-01": "1998-52"}
    assert _labels(spark, WeekGrain.prev, list(cases)) == list(cases.values())
    assert [lookback_labels_py(w, 1)[0] for w in cases] == list(cases.values())


@pytest.mark.parametrize("week,n", [("2021-02", 5), ("2020-30", 1), ("2021-01", 104), ("1998-53", 3)])
def test_lookback_is_the_previous_week_n_times(spark, week, n):
    want, w = [], week
    for _ in range(n):
        (w,) = lookback_labels_py(w, 1)
        want.append(w)
    assert lookback_labels_py(week, n) == want
    assert _labels(spark, lambda c: WeekGrain.lookback(c, n), [week]) == [want]


def test_lookback_of_three_years_and_clamp(spark):
    assert lookback_labels_py("2021-03", 3 * 52)[-1] == "2018-03"
    assert lookback_labels_py("2021-03", -2) == ["2021-02"]
    assert _labels(spark, lambda c: WeekGrain.lookback(c, -2), ["2021-03"]) == [["2021-02"]]


@pytest.mark.parametrize("grain,label", [(WeekGrain, "FY24-W05"), (WeekGrain, "2024"), (DayGrain, "2024-13-40")])
def test_malformed_labels_raise(spark, grain, label):
    with pytest.raises(Exception, match="period label"):
        _labels(spark, lambda c: grain.lookback(c, 1), [label])
    with pytest.raises(ValueError):
        lookback_labels_py(label, 1, grain.name)


def test_week_53_never_produced(spark):
    got = _labels(spark, lambda c: WeekGrain.lookback(c, 4), ["1999-02"])
    assert got == [["1999-01", "1998-52", "1998-51", "1998-50"]]


def test_day_grain_lookback(spark):
    got = _labels(spark, lambda c: DayGrain.lookback(c, 2), ["2024-03-01"])
    assert got == [["2024-02-29", "2024-02-28"]]
    assert lookback_labels_py("2024-03-01", 2, "day") == ["2024-02-29", "2024-02-28"]


BASE_REG = {
    "dashboard": "orders_daily",
    "dashboard_table": "mart.orders",
    "source_table": "raw.orders",
    "metrics": [{"name": "o_totalprice", "checks": ["reconciliation"]}],
}


def test_parts_sum_has_its_own_gate():
    reg = dict(BASE_REG, checks={"reconciliation": {"enabled": False}, "parts_sum": {"pivot_columns": ["o_orderstatus", "o_orderpriority", "o_custkey"]}})
    spec = normalize(reg)
    assert [(p.seq, p.pivot) for p in spec.parts] == [(1, "o_orderstatus"), (2, "o_orderpriority"), (3, "o_custkey")]
    assert not spec.reconciliation and spec.freshness_seq == 0


def test_a_check_on_the_source_needs_a_source():
    reg = {k: v for k, v in BASE_REG.items() if k != "source_table"}
    with pytest.raises(ValueError, match="source_table"):
        normalize(reg)
    alone = normalize(dict(reg, metrics=[{"name": "o_totalprice", "checks": ["trend_sanity"]}]))
    assert alone.trend and not alone.reconciliation and not alone.parts


def test_defaults_and_legacy_keys():
    reg = dict(BASE_REG, metrics=[{"name": "spend", "tolerance_pct": "2.5%"}], lookback_weeks=0, checks={})
    spec = normalize(reg)
    # a metric without ``checks`` gets reconciliation but no parts_sum
    assert [(c.metric, c.limit) for c in spec.reconciliation] == [("spend", 2.5)]
    assert spec.parts == []
    assert spec.lookback == 1
    assert spec.freshness_seq == 0
    reg = dict(BASE_REG, checks={"parts_sum": {"pivot_column": "region"}})
    assert [p.pivot for p in normalize(reg).parts] == ["region"]
    reg = dict(BASE_REG, checks={})
    assert [p.pivot for p in normalize(reg).parts] == ["platform"]
    reg = dict(BASE_REG, checks={"parts_sum": {"pivot_columns": []}})
    assert normalize(reg).parts == []


def test_completeness_gating_and_legacy_expected_values():
    reg = dict(
        BASE_REG,
        dimensions=[
            {"name": "a", "completeness_check": True, "expected_values": ["x", 1]},
            {"name": "b", "required_values": ["y"]},
        ],
    )
    spec = normalize(reg)
    assert [(c.dimension, c.required) for c in spec.completeness] == [("a", ("x", "1"))]


def test_execution_order():
    reg = dict(
        BASE_REG,
        metrics=[
            {"name": "m1", "checks": ["reconciliation", "trend_sanity"]},
            {"name": "m2", "checks": ["trend_sanity"]},
        ],
        dimensions=[{"name": "p", "completeness_check": True, "required_values": ["v"]}],
        checks={"parts_sum": {"pivot_columns": ["p", "q"]}, "sanity_range": {"rules": [{"name": "r", "expression": "m1 < 0"}]}},
    )
    spec = normalize(reg)
    assert spec.freshness_seq == 0
    assert [(c.seq, c.metric) for c in spec.reconciliation] == [(1, "m1")]
    assert [(c.seq, c.metric) for c in spec.trend] == [(2, "m1"), (3, "m2")]
    assert [(c.seq, c.pivot) for c in spec.parts] == [(4, "p"), (5, "q")]
    assert [c.seq for c in spec.completeness] == [6]
    assert [c.seq for c in spec.sanity] == [7]


def test_load_registry_yaml_and_missing_file():
    import os

    import pytest

    from tallyho.config import load_registry

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    reg = load_registry(os.path.join(here, "examples", "events_dashboard.yaml"))
    spec = normalize(reg)
    assert [c.metric for c in spec.reconciliation] == ["spend", "interactions"]
    assert [c.limit for c in spec.reconciliation] == [1.0, 1.0]
    assert [p.pivot for p in spec.parts] == ["platform", "pillar", "platform", "pillar"]
    assert spec.expected_changes[0].change == "appears" and spec.lookback == 4
    with pytest.raises(FileNotFoundError):
        load_registry(os.path.join(here, "examples", "absent.yaml"))
