from tallyho.functions.periods import DayGrain, WeekGrain, grain_of, lookback_labels_py, week_label
from tallyho.functions.scoring import (
    DRIFT,
    FAIL,
    PASS,
    overall_status,
    severity,
    tier_ladder,
)

__all__ = [
    "DRIFT",
    "FAIL",
    "PASS",
    "DayGrain",
    "WeekGrain",
    "grain_of",
    "lookback_labels_py",
    "overall_status",
    "severity",
    "tier_ladder",
    "week_label",
]
