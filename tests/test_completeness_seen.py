"""New values: the sorted pass over periods against the lookback labels spelled out."""

import random

import pytest

from tallyho.plans.suite import Suite


def before(label, n):
    y, w = int(label[:4]), int(label[5:])
    out = []
    for _ in range(n):
        y, w = (y - 1, 52) if w <= 1 else (y, w - 1)
        out.append(f"{y}-{w:02d}")
    return out


@pytest.mark.parametrize("runs", [None, ["2020-53", "2021-01", "2021-02", "2021-30"]])
def test_new_values_equal_the_spelled_out_lookback(spark, runs):
    r = random.Random(6)
    weeks = [f"{y}-{w:02d}" for y in (2020, 2021) for w in range(1, 54) if w < 53 or y == 2020]
    rows = [(w, s) for w in weeks for s in ("a", "b", "c", "d", None) if r.random() < 0.35] + [(None, "z")]
    facts = spark.createDataFrame(rows, "wk string, shop string")
    reg = {"dashboard": "d", "dashboard_table": facts, "date_column": "wk", "lookback_weeks": 3, "dimensions": [{"name": "shop", "completeness_check": True, "required_values": ["a"], "optional_values": ["b"]}], "checks": {"freshness": {"enabled": False}}}
    suite = Suite(spark, reg, runs=runs)
    _, new = suite.completeness_values()
    there = set(rows)
    want = {(w, s) for w, s in there if w and (runs is None or w in runs) and s not in ("a", "b") and not any((h, s) in there for h in before(w, 3))}
    assert {(x["run_week"], x["value"]) for x in new.collect()} == want and want
