"""Detail texts written into check results (format strings for ``format_string``).

Fixed values: the wording follows the texts the original tool writes into a
result's detail, so people reading the run log see the same messages.
"""

FRESHNESS = "Latest week in dashboard: %s"
RECON_BOTH_ZERO = "Both source and dashboard are zero — no data for this week"
RECON_GAP = "Gap: %.2f%%  (tolerance: ±%s%%)"
TREND_NO_HISTORY = "No data in lookback window (%s) — trend check skipped"
TREND_ZERO_BASELINE = "Lookback baseline is zero across %d week(s) — trend check skipped"
TREND_CHANGE = "Change vs %s: %+.1f%%  (limit: ±%s%%)"
TREND_ONE_WEEK = "prior week"
TREND_N_WEEKS = "%d-week avg"
PARTS_ALL_MATCH = "All %s subtotals match"
COMPLETENESS_MISSING = "Missing %s values: [%s]"
COMPLETENESS_ALL_PRESENT = "All %d expected %s values present"
PARTS_ITEM = "%s: expected %,.0f, got %,.0f (%.1f%%)"
SANITY_NO_ROWS = "No rows for %s — sanity check skipped"
SANITY_ALL_OK = "All %d rows satisfy rule '%s'"
SANITY_VIOLATIONS = "%d of %d rows violate rule '%s' (%s)"

# This library's own texts: the itemised lists live in separate row frames.
PARTS_FAILING = "%d of %d %s subtotals outside ±%s%% (see parts_sum_detail)"
COMPLETENESS_NEW = "  |  New %s values not seen in prior %d week(s): %d (see new_values)"
