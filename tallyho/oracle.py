"""DuckDB SQL for every named query: an independent statement of the semantics.

Each text repeats the fixture derivations as CTEs over the raw test tables
(``events``, ``lineitem``, ``orders``) and re-expresses the checks in plain
SQL with correlated counts and CROSS JOINs, the way a reviewer would write
them by hand.  Numbers are compared as DOUBLE rounded half-up on their
decimal text (``R2``), counts as BIGINT.
"""

from __future__ import annotations

# ── fixtures ────────────────────────────────────────────────────────────────

F1 = """src AS (
  SELECT event_id, strftime(ts, '%G-%V') AS wk,
         CASE WHEN event_id % 40 = 5 THEN NULL ELSE event_type END AS platform,
         CASE WHEN user_id % 2 = 0 THEN 'Paid' ELSE 'Organic' END AS pillar,
         CASE WHEN event_id % 10 = 0 THEN 'Budget' WHEN event_id % 10 = 1 THEN NULL ELSE 'Actual' END AS data_type,
         CAST(value AS DECIMAL(18,2)) AS spend,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS interactions
  FROM events),
dash AS (
  SELECT event_id, wk,
         CASE WHEN wk = '2024-04' AND platform = 'view' AND event_id % 4 = 3 THEN 'click'
              WHEN wk = '2024-02' AND platform = 'purchase' AND event_id % 9 = 7 THEN 'beta'
              ELSE platform END AS platform,
         pillar, data_type,
         CASE WHEN wk = '2024-03' THEN CAST(spend * 1.02 AS DECIMAL(18,2))
              WHEN wk = '2024-01' AND event_id % 100 = 3 THEN -spend ELSE spend END AS spend,
         interactions
  FROM src WHERE NOT (wk = '2024-02' AND src.platform = 'signup'))"""

F2 = """src AS (
  SELECT strftime(l_shipdate, '%G-%V') AS wk, l_returnflag AS segment, l_linestatus AS pillar,
         CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue
  FROM lineitem),
dash AS (SELECT * FROM src)"""

F3 = """dim_date AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS full_date, strftime(CAST(o_orderdate AS DATE), '%G-%V') AS fiscal_yr_and_wk_desc
  FROM orders)"""


def R2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 2) AS DOUBLE)"


# Exact average of cent amounts (every fixture metric has at most two decimals):
# the double nearest to cents / (100 n), and the average rounded half-up to cents.
_BASE = "CAST(cents AS DOUBLE) / (100.0 * n_weeks)"
_BASE_R = (
    "CAST(CASE WHEN cents >= 0 THEN (2 * cents + n_weeks) // (2 * n_weeks) "
    "ELSE -((-2 * cents + n_weeks) // (2 * n_weeks)) END AS DOUBLE) / 100.0"
)


def SEV(status: str = "status") -> str:
    return f"CASE {status} WHEN 'FAIL' THEN 'P2' WHEN 'DRIFT' THEN 'P3' END"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _label_of(j: str) -> str:
    return f"CAST(({j} - 1) // 52 AS VARCHAR) || '-' || lpad(CAST({j} - 52 * (({j} - 1) // 52) AS VARCHAR), 2, '0')"


def _week_idx(label: str) -> str:
    return f"(CAST(split_part({label}, '-', 1) AS INTEGER) * 52 + CAST(split_part({label}, '-', 2) AS INTEGER))"


# ── suite configurations (mirrors of the fixture registries) ────────────────

F1_CFG = dict(
    fixture=F1,
    metrics=[("spend", 1.0, True, True), ("interactions", 1.0, True, True)],
    max_change=50.0,
    pivots=["platform", "pillar"],
    dims=[("platform", ["click", "error", "purchase", "signup", "view"], [])],
    rules=[("spend_non_negative", "spend < 0")],
    lookback=4,
    row_filter="(data_type <> 'Budget' OR data_type IS NULL)",
    changes=[],
    freshness=True,
)

F2_CFG = dict(
    fixture=F2,
    metrics=[("quantity", 1.0, True, True), ("revenue", 2.0, True, True)],
    max_change=20.0,
    pivots=["segment", "pillar"],
    dims=[("segment", ["A", "N", "R"], [])],
    rules=[("quantity_positive", "quantity <= 0")],
    lookback=4,
    row_filter="TRUE",
    changes=[],
    freshness=True,
)


def _seqs(cfg):
    """Execution order: freshness, (recon, trend) per metric, parts, completeness, rules."""
    seq = 0
    out = {"fresh": None, "recon": [], "trend": [], "parts": [], "comp": [], "rules": []}
    if cfg["freshness"]:
        out["fresh"] = seq
        seq += 1
    for m, tol, rec, tr in cfg["metrics"]:
        if rec:
            out["recon"].append((seq, m, tol))
            seq += 1
        if tr:
            out["trend"].append((seq, m, cfg["max_change"]))
            seq += 1
    for m, tol, rec, _ in cfg["metrics"]:
        if rec:
            for p in cfg["pivots"]:
                out["parts"].append((seq, m, p, tol))
                seq += 1
    for d, req, opt in cfg["dims"]:
        out["comp"].append((seq, d, req, opt))
        seq += 1
    for name, expr in cfg["rules"]:
        out["rules"].append((seq, name, expr))
        seq += 1
    return out


def suite_ctes(cfg) -> str:
    """All check CTEs for one dashboard; ``results`` is their union."""
    q = _seqs(cfg)
    metrics = [m for m, *_ in cfg["metrics"]]
    group_cols = list(dict.fromkeys(cfg["pivots"] + [d for d, _, _ in cfg["dims"]]))
    n = max(int(cfg["lookback"]), 1)
    rf = cfg["row_filter"]
    ctes = [cfg["fixture"]]
    ctes.append(f"d AS (SELECT * FROM dash WHERE {rf})")
    ctes.append(f"s AS (SELECT * FROM src WHERE {rf})")
    ctes.append("runs AS (SELECT DISTINCT wk AS run_week FROM (SELECT wk FROM d UNION ALL SELECT wk FROM s) u WHERE wk IS NOT NULL)")

    def tot(t):
        return " UNION ALL ".join(
            f"SELECT wk, '{m}' AS metric, CAST(COALESCE(SUM({m}), 0) AS DOUBLE) AS total FROM {t} GROUP BY wk" for m in metrics
        )

    def grp(t):
        return " UNION ALL ".join(
            f"SELECT wk, '{c}' AS dim, CAST({c} AS VARCHAR) AS key, '{m}' AS metric, CAST(COALESCE(SUM({m}), 0) AS DOUBLE) AS total "
            f"FROM {t} GROUP BY wk, {c}"
            for c in group_cols
            for m in metrics
        )

    ctes.append(f"dt AS ({tot('d')})")
    ctes.append(f"st AS ({tot('s')})")
    if group_cols:
        ctes.append(f"dg AS ({grp('d')})")
        ctes.append(f"sg AS ({grp('s')})")
    lb = (
        f"lb AS (SELECT r.run_week, i.range AS pos, {_label_of(_week_idx('r.run_week') + ' - i.range')} AS hwk "
        f"FROM runs r CROSS JOIN range(1, {n + 1}) i)"
    )
    ctes.append(lb)
    parts_sql = []
    null = "CAST(NULL AS DOUBLE)"

    if q["fresh"] is not None:
        ctes.append(
            f"""fresh AS (
  SELECT r.run_week, {q['fresh']} AS check_seq, 'freshness' AS check_name, 'row_freshness' AS metric,
         CASE WHEN l.latest IS NOT DISTINCT FROM r.run_week THEN 'PASS' ELSE 'FAIL' END AS status,
         r.run_week AS expected, l.latest AS actual
  FROM runs r CROSS JOIN (SELECT MAX(wk) AS latest FROM d) l)"""
        )
        parts_sql.append(
            f"SELECT run_week, check_seq, check_name, metric, status, {null} AS expected_num, {null} AS actual_num, "
            f"{null} AS gap, {null} AS tolerance FROM fresh"
        )

    if q["recon"]:
        vals = ", ".join(f"({s}, '{m}', CAST({t} AS DOUBLE))" for s, m, t in q["recon"])
        ctes.append(
            f"""recon AS (
  SELECT run_week, check_seq, 'reconciliation' AS check_name, metric,
         CASE WHEN sv = 0 AND dv = 0 THEN 'PASS' WHEN gp <= tol THEN 'PASS' WHEN gp <= tol * 3 THEN 'DRIFT' ELSE 'FAIL' END AS status,
         CASE WHEN sv = 0 AND dv = 0 THEN 0.0 ELSE {R2('sv')} END AS expected_num,
         CASE WHEN sv = 0 AND dv = 0 THEN 0.0 ELSE {R2('dv')} END AS actual_num,
         CASE WHEN sv = 0 AND dv = 0 THEN NULL ELSE {R2('dv - sv')} END AS gap,
         CASE WHEN sv = 0 AND dv = 0 THEN NULL ELSE tol END AS tolerance,
         CASE WHEN sv = 0 AND dv = 0 THEN NULL ELSE {R2('gp')} END AS gap_pct
  FROM (SELECT *, CASE WHEN sv = 0 THEN (CASE WHEN dv <> 0 THEN 100.0 ELSE 0.0 END) ELSE abs(dv - sv) / abs(sv) * 100.0 END AS gp
        FROM (SELECT r.run_week, p.check_seq, p.metric, p.tol, COALESCE(a.total, 0.0) AS dv, COALESCE(b.total, 0.0) AS sv
              FROM runs r CROSS JOIN (VALUES {vals}) p(check_seq, metric, tol)
              LEFT JOIN dt a ON a.wk = r.run_week AND a.metric = p.metric
              LEFT JOIN st b ON b.wk = r.run_week AND b.metric = p.metric) x) y)"""
        )
        parts_sql.append("SELECT run_week, check_seq, check_name, metric, status, expected_num, actual_num, gap, tolerance FROM recon")

    if q["trend"]:
        vals = ", ".join(f"({s}, '{m}', CAST({t} AS DOUBLE))" for s, m, t in q["trend"])
        ctes.append(
            f"""trend AS (
  SELECT run_week, check_seq, 'trend_sanity' AS check_name, metric,
         CASE WHEN w IS NULL THEN 'PASS' WHEN abs(w) <= lim THEN 'PASS' WHEN abs(w) <= lim * 1.5 THEN 'DRIFT' ELSE 'FAIL' END AS status,
         CASE WHEN n_weeks = 0 THEN NULL WHEN baseline = 0 THEN 0.0 ELSE baseline_r END AS expected_num,
         {R2('cur')} AS actual_num, {R2('w')} AS gap, CASE WHEN w IS NOT NULL THEN lim END AS tolerance,
         baseline_r AS baseline, {R2('cur')} AS current, {R2('w')} AS change_pct, n_weeks, w
  FROM (SELECT *, CASE WHEN n_weeks > 0 AND baseline <> 0 THEN (cur - baseline) / abs(baseline) * 100.0 END AS w
        FROM (SELECT r.run_week, p.check_seq, p.metric, p.lim, COALESCE(c.total, 0.0) AS cur,
                     COALESCE(h.n_weeks, 0) AS n_weeks, h.baseline, h.baseline_r
              FROM runs r CROSS JOIN (VALUES {vals}) p(check_seq, metric, lim)
              LEFT JOIN dt c ON c.wk = r.run_week AND c.metric = p.metric
              LEFT JOIN (SELECT run_week, metric, n_weeks, {_BASE} AS baseline, {_BASE_R} AS baseline_r
                         FROM (SELECT lb.run_week, dt.metric, COUNT(*) AS n_weeks,
                                      SUM(CAST(ROUND(dt.total * 100) AS HUGEINT)) AS cents
                               FROM lb JOIN dt ON dt.wk = lb.hwk GROUP BY lb.run_week, dt.metric) hc) h
                ON h.run_week = r.run_week AND h.metric = p.metric) x) y)"""
        )
        parts_sql.append("SELECT run_week, check_seq, check_name, metric, status, expected_num, actual_num, gap, tolerance FROM trend")

    if q["parts"]:
        vals = ", ".join(f"({s}, '{m}', '{p}', CAST({t} AS DOUBLE))" for s, m, p, t in q["parts"])
        ctes.append(f"pspec AS (SELECT * FROM (VALUES {vals}) v(check_seq, metric, piv, tol))")
        ctes.append(
            """pc AS (
  SELECT *, src_total <> 0 AND gap_pct > tol AND NOT isnan(gap_pct) AS failing
  FROM (SELECT s.wk AS run_week, p.check_seq, p.metric, p.piv, s.key AS pivot_value, p.tol,
               s.total AS src_total, COALESCE(g.total, 0.0) AS dash_total,
               CASE WHEN s.total <> 0 THEN abs(COALESCE(g.total, 0.0) - s.total) / abs(s.total) * 100.0 END AS gap_pct
        FROM sg s JOIN pspec p ON s.dim = p.piv AND s.metric = p.metric
        LEFT JOIN dg g ON g.wk = s.wk AND g.dim = s.dim AND g.metric = s.metric AND g.key IS NOT DISTINCT FROM s.key
        WHERE s.wk IN (SELECT run_week FROM runs)) x)"""
        )
        ctes.append(
            """parts AS (
  SELECT r.run_week, p.check_seq, 'parts_sum' AS check_name, p.metric || '_by_' || p.piv AS metric,
         CASE WHEN COALESCE(c.n_fail, 0) = 0 THEN 'PASS' WHEN c.n_fail = 1 THEN 'DRIFT' ELSE 'FAIL' END AS status,
         CAST(COALESCE(c.n_src, 0) AS DOUBLE) AS expected_num, CAST(COALESCE(k.n_dash, 0) AS DOUBLE) AS actual_num,
         CAST(NULL AS DOUBLE) AS gap, CAST(NULL AS DOUBLE) AS tolerance, COALESCE(c.n_fail, 0) AS n_failing
  FROM runs r CROSS JOIN pspec p
  LEFT JOIN (SELECT run_week, metric, piv, COUNT(*) AS n_src, COUNT(*) FILTER (WHERE failing) AS n_fail
             FROM pc GROUP BY run_week, metric, piv) c
    ON c.run_week = r.run_week AND c.metric = p.metric AND c.piv = p.piv
  LEFT JOIN (SELECT wk, metric, dim, COUNT(*) AS n_dash FROM dg GROUP BY wk, metric, dim) k
    ON k.wk = r.run_week AND k.metric = p.metric AND k.dim = p.piv)"""
        )
        parts_sql.append("SELECT run_week, check_seq, check_name, metric, status, expected_num, actual_num, gap, tolerance FROM parts")

    if q["comp"]:
        comp_parts = []
        for seq, dim, req, opt in q["comp"]:
            rows = [f"({_lit(v)}, 'required', {i})" for i, v in enumerate(req)] + [
                f"({_lit(v)}, 'optional', {i})" for i, v in enumerate(opt)
            ]
            vals = ", ".join(rows) if rows else "(NULL, 'none', 0)"
            def until(c):
                later = [x["effective_week"] for x in cfg["changes"] if (x["dimension"], x["value"]) == (c["dimension"], c["value"]) and x["effective_week"] > c["effective_week"]]
                return f" AND run_week < '{min(later)}'" if later else ""

            own = [c for c in cfg["changes"] if c["dimension"] == dim]
            gone = " OR ".join(
                f"(q.value IS NOT DISTINCT FROM {_lit(c['value'])} AND run_week >= '{c['effective_week']}'{until(c)})" for c in own if c["change"] == "disappears"
            ) or "FALSE"
            appears = " UNION ALL ".join(
                f"SELECT run_week, {_lit(c['value'])} AS value FROM runs WHERE run_week >= '{c['effective_week']}'{until(c)}" for c in own if c["change"] == "appears"
            )
            t = f"c{seq}"
            ctes.append(f"{t}_vals AS (SELECT * FROM (VALUES {vals}) v(value, kind, pos) WHERE kind <> 'none')")
            ctes.append(
                f"{t}_present AS (SELECT DISTINCT wk AS run_week, CAST({dim} AS VARCHAR) AS value FROM d WHERE wk IN (SELECT run_week FROM runs))"
            )
            ctes.append(
                f"{t}_req AS (SELECT r.run_week, q.value, q.pos FROM runs r CROSS JOIN {t}_vals q WHERE q.kind = 'required' AND NOT ({gone}))"
            )
            ctes.append(
                f"""{t}_missing AS (SELECT q.* FROM {t}_req q
   WHERE NOT EXISTS (SELECT 1 FROM {t}_present p WHERE p.run_week = q.run_week AND p.value IS NOT DISTINCT FROM q.value))"""
            )
            known = (
                f"SELECT lb.run_week, CAST(d.{dim} AS VARCHAR) AS value FROM lb JOIN d ON d.wk = lb.hwk "
                f"UNION ALL SELECT r.run_week, q.value FROM runs r CROSS JOIN {t}_vals q"
                + (f" UNION ALL {appears}" if appears else "")
            )
            ctes.append(f"{t}_known AS ({known})")
            ctes.append(
                f"""{t}_new AS (SELECT p.* FROM {t}_present p
   WHERE NOT EXISTS (SELECT 1 FROM {t}_known k WHERE k.run_week = p.run_week AND k.value IS NOT DISTINCT FROM p.value))"""
            )
            ctes.append(
                f"""{t} AS (
  SELECT run_week, {seq} AS check_seq, 'completeness' AS check_name, '{dim}_completeness' AS metric,
         CASE WHEN n_missing = 0 AND n_new > 0 THEN 'DRIFT' WHEN n_missing = 0 THEN 'PASS'
              WHEN n_missing = 1 THEN 'DRIFT' ELSE 'FAIL' END AS status,
         CAST(n_required AS DOUBLE) AS expected_num, CAST(n_present AS DOUBLE) AS actual_num,
         CAST(NULL AS DOUBLE) AS gap, CAST(NULL AS DOUBLE) AS tolerance, n_missing, n_new, missing_values, '{dim}' AS dimension
  FROM (SELECT r.run_week,
               (SELECT COUNT(*) FROM {t}_req q WHERE q.run_week = r.run_week) AS n_required,
               (SELECT COUNT(*) FROM {t}_missing q WHERE q.run_week = r.run_week) AS n_missing,
               (SELECT COUNT(*) FROM {t}_new q WHERE q.run_week = r.run_week) AS n_new,
               (SELECT COUNT(*) FROM {t}_present q WHERE q.run_week = r.run_week) AS n_present,
               COALESCE((SELECT string_agg(COALESCE(q.value, 'None'), ', ' ORDER BY q.pos) FROM {t}_missing q
                         WHERE q.run_week = r.run_week), '') AS missing_values
        FROM runs r) x)"""
            )
            comp_parts.append(f"SELECT * FROM {t}")
        ctes.append("comp AS (" + " UNION ALL ".join(comp_parts) + ")")
        ctes.append(
            "comp_missing AS (" + " UNION ALL ".join(f"SELECT run_week, '{d}' AS dimension, value FROM c{s}_missing" for s, d, _, _ in q["comp"]) + ")"
        )
        ctes.append(
            "comp_new AS (" + " UNION ALL ".join(f"SELECT run_week, '{d}' AS dimension, value FROM c{s}_new" for s, d, _, _ in q["comp"]) + ")"
        )
        parts_sql.append("SELECT run_week, check_seq, check_name, metric, status, expected_num, actual_num, gap, tolerance FROM comp")

    if q["rules"]:
        rule_parts = []
        for seq, name, expr in q["rules"]:
            rule_parts.append(
                f"""SELECT r.run_week, {seq} AS check_seq, 'sanity_range' AS check_name, '{name}' AS metric,
         CASE WHEN COALESCE(w.n, 0) = 0 OR COALESCE(w.v, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
         0.0 AS expected_num, CAST(CASE WHEN COALESCE(w.n, 0) = 0 THEN 0 ELSE COALESCE(w.v, 0) END AS DOUBLE) AS actual_num,
         CAST(NULL AS DOUBLE) AS gap, CAST(NULL AS DOUBLE) AS tolerance,
         CAST(COALESCE(w.n, 0) AS BIGINT) AS n_rows, CAST(COALESCE(w.v, 0) AS BIGINT) AS violations
  FROM runs r LEFT JOIN (SELECT wk, COUNT(*) AS n, SUM(CASE WHEN {expr} THEN 1 ELSE 0 END) AS v FROM d GROUP BY wk) w
    ON w.wk = r.run_week"""
            )
        ctes.append("sanity AS (" + " UNION ALL ".join(rule_parts) + ")")
        parts_sql.append("SELECT run_week, check_seq, check_name, metric, status, expected_num, actual_num, gap, tolerance FROM sanity")

    ctes.append("results AS (" + " UNION ALL ".join(parts_sql) + ")")
    ctes.append(
        """summary AS (
  SELECT r.run_week, COUNT(x.status) AS total,
         COUNT(*) FILTER (WHERE x.status = 'PASS') AS pass, COUNT(*) FILTER (WHERE x.status = 'DRIFT') AS drift,
         COUNT(*) FILTER (WHERE x.status = 'FAIL') AS fail
  FROM runs r LEFT JOIN results x ON x.run_week = r.run_week GROUP BY r.run_week)"""
    )
    return "WITH " + ",\n".join(ctes) + "\n"


RES = f"run_week, check_seq, check_name, metric, status, {SEV()} AS severity, expected_num, actual_num, gap, tolerance"
OVERALL = "CASE WHEN fail > 0 THEN 'FAIL' WHEN drift > 0 THEN 'DRIFT' ELSE 'PASS' END"


def _with(cfg, **kw):
    c = dict(cfg)
    c.update(kw)
    return c


def _log_select(ctes: str, ts: str, dashboard: str) -> str:
    """Log rows of one run; expected/actual text follows the result kinds."""
    return f"""{ctes}SELECT '{dashboard}_' || x.run_week || '_{ts}' AS run_id, '{dashboard}' AS dashboard, x.run_week,
       '{ts}' AS run_timestamp, {OVERALL} AS overall_status, x.check_name, x.metric, x.status, {SEV('x.status')} AS severity,
       x.gap, x.tolerance
FROM results x JOIN summary s ON s.run_week = x.run_week"""


def _float_text(x: str) -> str:
    return f"regexp_replace(regexp_replace(CAST(CAST({x} AS DECIMAL(38,10)) AS VARCHAR), '0+$', ''), '\\.$', '.0')"


def _log_rows_sql(cfg, ts: str, dashboard: str) -> str:
    ctes = suite_ctes(cfg)
    return f"""{ctes}SELECT '{dashboard}_' || x.run_week || '_{ts}' AS run_id, '{dashboard}' AS dashboard, x.run_week,
       '{ts}' AS run_timestamp, {OVERALL} AS overall_status, x.check_name, x.metric, x.status, {SEV('x.status')} AS severity,
       CASE WHEN x.check_name = 'freshness' THEN f.expected
            WHEN x.check_name = 'reconciliation' AND x.gap IS NULL THEN '0'
            WHEN x.check_name = 'reconciliation' THEN {_float_text('x.expected_num')}
            WHEN x.check_name = 'trend_sanity' AND x.expected_num IS NULL THEN NULL
            WHEN x.check_name = 'trend_sanity' THEN {_float_text('x.expected_num')}
            ELSE CAST(CAST(x.expected_num AS BIGINT) AS VARCHAR) END AS expected,
       CASE WHEN x.check_name = 'freshness' THEN f.actual
            WHEN x.check_name = 'reconciliation' AND x.gap IS NULL THEN '0'
            WHEN x.check_name IN ('reconciliation', 'trend_sanity') THEN {_float_text('x.actual_num')}
            ELSE CAST(CAST(x.actual_num AS BIGINT) AS VARCHAR) END AS actual,
       x.gap, x.tolerance, '' AS triage_analysis
FROM results x JOIN summary s ON s.run_week = x.run_week
LEFT JOIN fresh f ON f.run_week = x.run_week AND x.check_name = 'freshness'"""


def _whole(x: str, sign: bool = False) -> str:
    """A number rounded to a whole one, with thousands separators."""
    plus = f"CASE WHEN {x} >= 0 THEN '+' ELSE '' END || " if sign else ""
    return f"({plus}format('{{:,d}}', CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 0) AS BIGINT)))"


def _tenth(x: str, sign: bool = False) -> str:
    plus = f"CASE WHEN {x} >= 0 THEN '+' ELSE '' END || " if sign else ""
    return f"({plus}CAST(CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 1) AS DECIMAL(38,1)) AS VARCHAR))"


def _texts_ctes(cfg) -> str:
    """``texts``: every result with the texts that reports show of it; ``items``: what the results itemise."""
    q = _seqs(cfg)
    n = max(int(cfg["lookback"]), 1)
    lists = "string_agg(COALESCE(chr(39) || value || chr(39), 'None'), ', ' ORDER BY pos)"
    comp = " UNION ALL ".join(
        f"""SELECT c.run_week, c.check_seq,
      CASE WHEN n_missing > 0 THEN 'Missing {d} values: [' || (SELECT {lists} FROM c{s}_missing m WHERE m.run_week = c.run_week) || ']'
           ELSE 'All ' || CAST(expected_num AS BIGINT) || ' expected {d} values present' END
      || CASE WHEN n_new > 0 THEN '  |  New {d} values not seen in prior {n} week(s): ' || n_new || ' (see new_values)' ELSE '' END AS detail
    FROM c{s} c"""
        for s, d, _, _ in q["comp"]
    )
    rules = " UNION ALL ".join(f"SELECT {s} AS check_seq, {_lit(x)} AS expression" for s, _, x in q["rules"])
    missing = " UNION ALL ".join(f"SELECT run_week, {s} AS check_seq, '{d}_completeness' AS metric, 'missing_value' AS item_kind, pos AS place, value FROM c{s}_missing" for s, d, _, _ in q["comp"])
    new = " UNION ALL ".join(f"SELECT run_week, {s}, '{d}_completeness', 'new_value', 0, value FROM c{s}_new" for s, d, _, _ in q["comp"])
    none = "CAST(NULL AS DOUBLE)"
    return f""",
details AS (
  SELECT run_week, check_seq, 'Latest week in dashboard: ' || COALESCE(actual, 'None') AS detail FROM fresh
  UNION ALL SELECT r.run_week, r.check_seq, CASE WHEN gap IS NULL THEN 'Both source and dashboard are zero — no data for this week'
      ELSE printf('Gap: %.2f%%  (tolerance: ±%s%%)', gap_pct, CAST(tolerance AS VARCHAR)) END FROM recon r
  UNION ALL SELECT t.run_week, t.check_seq, CASE
      WHEN n_weeks = 0 THEN 'No data in lookback window (' || (SELECT string_agg(hwk, ', ' ORDER BY pos) FROM lb WHERE lb.run_week = t.run_week) || ') — trend check skipped'
      WHEN w IS NULL THEN 'Lookback baseline is zero across ' || n_weeks || ' week(s) — trend check skipped'
      ELSE 'Change vs ' || CASE WHEN n_weeks = 1 THEN 'prior week' ELSE n_weeks || '-week avg' END || ': ' || {_tenth("w", True)} || '%  (limit: ±{cfg["max_change"]}%)' END FROM trend t
  UNION ALL SELECT p.run_week, p.check_seq, CASE WHEN n_failing = 0 THEN 'All ' || piv || ' subtotals match'
      ELSE n_failing || ' of ' || (SELECT COUNT(*) FROM pc WHERE pc.run_week = p.run_week AND pc.check_seq = p.check_seq AND src_total <> 0)
        || ' ' || piv || ' subtotals outside ±' || CAST(tol AS VARCHAR) || '% (see parts_sum_detail)' END
    FROM (SELECT parts.*, pspec.piv, pspec.tol FROM parts JOIN pspec ON pspec.check_seq = parts.check_seq) p
  UNION ALL {comp}
  UNION ALL SELECT s.run_week, s.check_seq, CASE WHEN n_rows = 0 THEN 'No rows for ' || run_week || ' — sanity check skipped'
      WHEN violations = 0 THEN 'All ' || n_rows || ' rows satisfy rule ' || chr(39) || metric || chr(39)
      ELSE violations || ' of ' || n_rows || ' rows violate rule ' || chr(39) || metric || chr(39) || ' (' || x.expression || ')' END
    FROM sanity s JOIN ({rules}) x ON x.check_seq = s.check_seq),
texts AS (
  SELECT x.*, {SEV('x.status')} AS severity, d.detail,
    CASE WHEN x.check_name = 'freshness' THEN f.expected WHEN x.check_name = 'reconciliation' AND x.gap IS NULL THEN '0'
      WHEN x.check_name = 'trend_sanity' AND x.expected_num IS NULL THEN 'None' WHEN x.check_name IN ('reconciliation', 'trend_sanity') THEN {_float_text('x.expected_num')}
      ELSE CAST(CAST(x.expected_num AS BIGINT) AS VARCHAR) END AS expected,
    CASE WHEN x.check_name = 'freshness' THEN COALESCE(f.actual, 'None') WHEN x.check_name = 'reconciliation' AND x.gap IS NULL THEN '0'
      WHEN x.check_name IN ('reconciliation', 'trend_sanity') THEN {_float_text('x.actual_num')} ELSE CAST(CAST(x.actual_num AS BIGINT) AS VARCHAR) END AS actual
  FROM results x JOIN details d ON d.run_week = x.run_week AND d.check_seq = x.check_seq
  LEFT JOIN fresh f ON f.run_week = x.run_week AND x.check_name = 'freshness'),
unnumbered AS (
  SELECT run_week, check_seq, 'parts_sum' AS check_name, metric || '_by_' || piv AS metric, 'failing_group' AS item_kind, 0 AS place, pivot_value AS value,
    {R2('src_total')} AS expected_num, {R2('dash_total')} AS actual_num, {R2('gap_pct')} AS gap_pct,
    COALESCE(pivot_value, 'None') || ': expected ' || {_whole('src_total')} || ', got ' || {_whole('dash_total')} || ' (' || {_tenth('gap_pct')} || '%)' AS text
  FROM pc WHERE failing
  UNION ALL SELECT run_week, check_seq, 'completeness', metric, item_kind, place, value, {none}, {none}, {none}, COALESCE(value, 'None') FROM ({missing} UNION ALL {new}) v),
items AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_week, check_seq, item_kind ORDER BY place, value NULLS LAST) AS position FROM unnumbered)
"""


def _f4_log(cfg) -> str:
    """Both logged runs of F4 as one CTE chain (``log``)."""
    out = []
    for ts, tol in (("2024-02-05T06:00:00", 1.0), ("2024-02-05T07:00:00", 5.0)):
        c = _with(cfg, metrics=[(m, tol, r, t) for m, _, r, t in cfg["metrics"]])
        ctes = suite_ctes(c)
        out.append(
            f"""({ctes}SELECT 'events_dashboard_' || x.run_week || '_{ts}' AS run_id, 'events_dashboard' AS dashboard, x.run_week,
       '{ts}' AS run_timestamp, {OVERALL} AS overall_status, x.check_name, x.metric, x.status
FROM results x JOIN summary s ON s.run_week = x.run_week)"""
        )
    return "WITH log AS (" + " UNION ALL ".join(f"SELECT * FROM {o}" for o in out) + ")\n"


def _day_trend_sql() -> str:
    return """WITH facts AS (SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS total_price FROM orders),
t AS (SELECT order_date, CAST(COALESCE(SUM(total_price), 0) AS DOUBLE) AS total FROM facts GROUP BY order_date),
runs AS (SELECT DISTINCT order_date AS day FROM facts WHERE order_date IS NOT NULL),
h AS (SELECT day, n_weeks, """ + _BASE + """ AS baseline, """ + _BASE_R + """ AS baseline_r
      FROM (SELECT r.day, COUNT(*) AS n_weeks, SUM(CAST(ROUND(t.total * 100) AS HUGEINT)) AS cents
            FROM runs r CROSS JOIN range(1, 8) i JOIN t ON t.order_date = r.day - CAST(i.range AS INTEGER) GROUP BY r.day) hc),
x AS (SELECT r.day, COALESCE(c.total, 0.0) AS cur, COALESCE(h.n_weeks, 0) AS n_weeks, h.baseline, h.baseline_r
      FROM runs r LEFT JOIN t c ON c.order_date = r.day LEFT JOIN h ON h.day = r.day),
y AS (SELECT *, CASE WHEN n_weeks > 0 AND baseline <> 0 THEN (cur - baseline) / abs(baseline) * 100.0 END AS w FROM x)
SELECT CAST(day AS VARCHAR) AS day, baseline_r AS baseline, """ + R2("cur") + " AS current, " + R2("w") + """ AS change_pct, n_weeks,
       CASE WHEN w IS NULL THEN 'PASS' WHEN abs(w) <= 50.0 THEN 'PASS' WHEN abs(w) <= 75.0 THEN 'DRIFT' ELSE 'FAIL' END AS status
FROM y"""


def oracle() -> dict[str, str]:
    f1 = suite_ctes(F1_CFG)
    f2 = suite_ctes(F2_CFG)
    f1_single = suite_ctes(_with(F1_CFG, pivots=["platform"]))
    f1_lim20 = suite_ctes(_with(F1_CFG, max_change=20.0))
    f1_changes = suite_ctes(
        _with(
            F1_CFG,
            changes=[
                {"dimension": "platform", "value": "signup", "change": "disappears", "effective_week": "2024-02"},
                {"dimension": "platform", "value": "beta", "change": "appears", "effective_week": "2024-02"},
            ],
        )
    )
    reversed_changes = [
        {"dimension": "platform", "value": v, "change": c, "effective_week": w}
        for v, c, w in (("signup", "disappears", "2024-01"), ("signup", "appears", "2024-02"), ("beta", "appears", "2024-01"), ("beta", "disappears", "2024-02"), ("click", "disappears", "2024-03"))
    ]
    f1_reversed = suite_ctes(_with(F1_CFG, changes=reversed_changes))
    f2_filtered = suite_ctes(_with(F2_CFG, row_filter="pillar = 'F'"))
    sql: dict[str, str] = {}
    sql["reconciliation"] = f1 + f"SELECT {RES}, gap_pct FROM recon"
    sql["verify_totals"] = (
        "WITH " + F1 + ",\n"
        + "v AS (SELECT 'dashboard' AS source, wk AS run_week, 'spend' AS metric, CAST(COALESCE(SUM(spend), 0) AS DOUBLE) AS total FROM dash GROUP BY wk "
        "UNION ALL SELECT 'dashboard', wk, 'interactions', CAST(COALESCE(SUM(interactions), 0) AS DOUBLE) FROM dash GROUP BY wk "
        "UNION ALL SELECT 'silver', wk, 'spend', CAST(COALESCE(SUM(spend), 0) AS DOUBLE) FROM src GROUP BY wk "
        "UNION ALL SELECT 'silver', wk, 'interactions', CAST(COALESCE(SUM(interactions), 0) AS DOUBLE) FROM src GROUP BY wk)\n"
        "SELECT * FROM v"
    )
    sql["freshness"] = f1 + f"SELECT run_week, check_name, metric, status, {SEV()} AS severity, expected, actual FROM fresh"
    sql["resolve_run_week"] = (
        "WITH " + F3 + "\n"
        "SELECT a.as_of, (SELECT MAX(fiscal_yr_and_wk_desc) FROM dim_date WHERE full_date <= CAST(a.as_of AS DATE)) AS run_week "
        "FROM (VALUES ('1995-06-15'), ('1990-01-01'), ('1999-12-31')) a(as_of)"
    )
    sql["parts_sum"] = f1_single + f"SELECT {RES}, n_failing FROM parts"
    sql["parts_sum_multi_pivot"] = f1 + f"SELECT {RES}, n_failing FROM parts"
    sql["parts_sum_detail"] = f1 + (
        "SELECT run_week, metric, piv AS \"pivot\", pivot_value, " + R2("src_total") + " AS source_total, " + R2("dash_total")
        + " AS dashboard_total, " + R2("gap_pct") + " AS gap_pct, COALESCE(failing, FALSE) AS is_failing FROM pc"
    )
    sql["trend_sanity"] = f1 + f"SELECT {RES}, baseline, current, change_pct, n_weeks FROM trend"
    sql["trend_sanity_limit20"] = f1_lim20 + f"SELECT {RES}, baseline, current, change_pct, n_weeks FROM trend"
    sql["weekly_totals"] = f1 + "SELECT wk AS week, metric, total FROM dt"
    sql["prev_week"] = (
        "WITH " + F2 + ",\nlabels AS (SELECT DISTINCT wk AS run_week FROM src)\n"
        "SELECT run_week, CASE WHEN CAST(split_part(run_week, '-', 2) AS INTEGER) <= 1 "
        "THEN CAST(CAST(split_part(run_week, '-', 1) AS INTEGER) - 1 AS VARCHAR) || '-52' "
        "ELSE split_part(run_week, '-', 1) || '-' || lpad(CAST(CAST(split_part(run_week, '-', 2) AS INTEGER) - 1 AS VARCHAR), 2, '0') END AS prev_week "
        "FROM labels"
    )
    sql["lookback_weeks"] = (
        "WITH " + F2 + ",\nlabels AS (SELECT DISTINCT wk AS run_week FROM src)\n"
        f"SELECT run_week, CAST(i.range AS INTEGER) AS pos, {_label_of(_week_idx('run_week') + ' - i.range')} AS prev_week "
        "FROM labels CROSS JOIN range(1, 5) i"
    )
    sql["trend_backfill"] = f2 + "SELECT run_week, metric, baseline, current, change_pct, n_weeks, status FROM trend WHERE run_week IN (SELECT wk FROM dt)"
    sql["trend_backfill_join"] = f2 + "SELECT run_week, metric, baseline, current, change_pct, n_weeks, status FROM trend"
    idx = _week_idx
    sql["trend_backfill_segments"] = f2.rstrip() + f""",
cells AS (SELECT '' AS dimension, CAST(NULL AS VARCHAR) AS segment, wk, metric, total FROM dt UNION ALL SELECT dim, key, wk, metric, total FROM dg WHERE dim = 'segment'),
spans AS (SELECT dimension, segment, metric, MIN({idx('wk')}) AS first FROM cells GROUP BY ALL),
grid AS (SELECT s.*, r.wk AS run_week FROM spans s CROSS JOIN (SELECT DISTINCT wk FROM dt) r WHERE {idx('r.wk')} >= s.first),
hist AS (SELECT g.dimension, g.segment, g.metric, g.run_week, COUNT(c.total) AS n_weeks, SUM(CAST(ROUND(c.total * 100) AS HUGEINT)) AS cents
  FROM grid g JOIN lb ON lb.run_week = g.run_week JOIN cells c ON c.dimension = g.dimension AND c.segment IS NOT DISTINCT FROM g.segment AND c.metric = g.metric AND c.wk = lb.hwk GROUP BY ALL),
graded AS (SELECT g.dimension, g.segment, g.metric, g.run_week, COALESCE(c.total, 0.0) AS cur, COALESCE(h.n_weeks, 0) AS n_weeks,
    CASE WHEN h.n_weeks > 0 THEN {_BASE} END AS base, CASE WHEN h.n_weeks > 0 THEN {_BASE_R} END AS baseline
  FROM grid g LEFT JOIN cells c ON c.dimension = g.dimension AND c.segment IS NOT DISTINCT FROM g.segment AND c.metric = g.metric AND c.wk = g.run_week
  LEFT JOIN hist h ON h.dimension = g.dimension AND h.segment IS NOT DISTINCT FROM g.segment AND h.metric = g.metric AND h.run_week = g.run_week),
judged AS (SELECT *, CASE WHEN base <> 0 THEN (cur - base) / abs(base) * 100.0 END AS w FROM graded)
SELECT dimension, segment, run_week, metric, baseline, {R2('cur')} AS current, {R2('w')} AS change_pct, n_weeks,
  CASE WHEN w IS NULL OR abs(w) <= 20.0 THEN 'PASS' WHEN abs(w) <= 30.0 THEN 'DRIFT' ELSE 'FAIL' END AS status FROM judged"""
    sql["completeness"] = f1 + f"SELECT {RES}, n_missing, n_new, missing_values FROM comp"
    sql["missing_values"] = f1 + "SELECT run_week, dimension, value FROM comp_missing"
    sql["new_values"] = f1 + "SELECT run_week, dimension, value FROM comp_new"
    sql["completeness_expected_changes"] = f1_changes + f"SELECT {RES}, n_missing, n_new, missing_values FROM comp"
    sql["completeness_change_reversed"] = f1_reversed + f"SELECT {RES}, n_missing, n_new, missing_values FROM comp"
    sql["sanity_range"] = f1 + f"SELECT {RES}, n_rows, violations FROM sanity"
    sql["suite_results"] = f1 + f"SELECT {RES} FROM results"
    sql["run_summary"] = f1 + f"SELECT 'events_dashboard' AS dashboard, run_week, total, pass, drift, fail, {OVERALL} AS overall_status FROM summary"
    sql["suite_single_week"] = f1 + f"SELECT {RES} FROM results WHERE run_week = '2024-03'"
    sql["rerun_late_weeks"] = f1 + f"SELECT {RES} FROM results WHERE run_week IN (SELECT wk FROM src WHERE event_id % 50 = 7 AND wk IN ('2024-03', '2024-04'))"
    sql["validate_log"] = f"SELECT * FROM ({_log_rows_sql(F1_CFG, '2024-02-05T06:00:00', 'events_dashboard')}) WHERE run_week = '2024-03'"
    sql["suite_backfill"] = f2 + f"SELECT {RES} FROM results"
    sql["suite_row_filter"] = f2_filtered + f"SELECT {RES} FROM results"
    sql["suite_multi_dashboard"] = (
        f1 + f"SELECT 'events_dashboard' AS dashboard, run_week, total, pass, drift, fail, {OVERALL} AS overall_status FROM summary"
        "\nUNION ALL\n"
        + "SELECT * FROM (" + f2 + f"SELECT 'lineitem_backfill' AS dashboard, run_week, total, pass, drift, fail, {OVERALL} AS overall_status FROM summary)"
    )
    sql["trend_daily"] = _day_trend_sql()
    sql["log_rows"] = _log_rows_sql(F1_CFG, "2024-02-05T06:00:00", "events_dashboard")
    sql["rerun_on_arrival"] = sql["log_rows"]
    log = _f4_log(F1_CFG)
    sql["log_append_roundtrip"] = log + "SELECT run_id, COUNT(*) AS n_rows FROM log GROUP BY run_id"
    sql["latest_run"] = log + (
        "SELECT dashboard, run_week, run_timestamp, check_name, metric, status FROM log l "
        "WHERE run_timestamp = (SELECT MAX(run_timestamp) FROM log m WHERE m.dashboard = l.dashboard AND m.run_week = l.run_week)"
    )
    sql["latest_run_summary"] = log + (
        "SELECT DISTINCT run_id, dashboard, run_week, run_timestamp, overall_status FROM log l "
        "WHERE run_timestamp = (SELECT MAX(run_timestamp) FROM log m WHERE m.dashboard = l.dashboard AND m.run_week = l.run_week)"
    )
    sql["drift_frequency"] = log + (
        "SELECT dashboard, split_part(run_week, '-', 1) || '-Q' || CAST(LEAST(CAST(ceil(CAST(split_part(run_week, '-', 2) AS INTEGER) / 13.0) AS INTEGER), 4) AS VARCHAR) AS quarter, "
        "check_name, COUNT(DISTINCT run_id) AS n_runs, COUNT(*) AS n_checks, COUNT(*) FILTER (WHERE status = 'DRIFT') AS n_drift, COUNT(*) FILTER (WHERE status = 'FAIL') AS n_fail "
        "FROM log l WHERE run_timestamp = (SELECT MAX(run_timestamp) FROM log m WHERE m.dashboard = l.dashboard AND m.run_week = l.run_week) "
        "GROUP BY 1, 2, 3"
    )
    sql["report_headers"] = f1 + (
        f"SELECT 'events_dashboard' AS dashboard, run_week, total, pass, drift, fail, {OVERALL} AS overall_status, "
        f"CASE WHEN {OVERALL} = 'PASS' THEN 'events_dashboard — ' || total || '/' || total || ' checks PASS' "
        "ELSE 'events_dashboard — ' || fail || ' FAIL on ' || run_week END AS headline FROM summary"
    )
    sql["report_lines"] = f1 + f"SELECT run_week, check_seq, check_name, metric, status, {SEV()} AS severity FROM results WHERE status <> 'PASS'"
    shown = f1.rstrip() + _texts_ctes(F1_CFG)
    sql["result_details"] = shown + "SELECT run_week, check_seq, detail FROM texts"
    gap = f"CASE WHEN check_name = 'trend_sanity' THEN {_tenth('gap', True)} || '%' ELSE {_whole('gap', True)} END"
    sql["report_line_text"] = shown + (
        "SELECT run_week, check_seq, '[' || check_name || '] ' || metric || ': ' || status || ' (severity ' || severity || ') | Expected: ' || expected || '   Got: ' || actual "
        f"|| CASE WHEN gap IS NOT NULL AND tolerance IS NOT NULL THEN '   Gap: ' || {gap} || '   Tolerance: ±' || {_float_text('tolerance')} || '%' ELSE '' END "
        "|| ' | ' || detail AS line FROM texts WHERE status <> 'PASS'"
    )
    sql["triage_context"] = shown + (
        "SELECT run_week, COUNT(*) AS n_failing, string_agg('check: ' || check_name || '  |  metric: ' || metric || '  |  status: ' || status || chr(10) "
        "|| '  expected: ' || expected || '  |  got: ' || actual || chr(10) || '  detail: ' || detail, chr(10) ORDER BY check_seq) AS context "
        "FROM texts WHERE status <> 'PASS' GROUP BY run_week"
    )
    sql["run_items"] = shown + "SELECT run_week, check_seq, check_name, metric, item_kind, position, value AS item, expected_num, actual_num, gap_pct, text FROM items"
    sql["run_item_texts"] = shown + (
        "SELECT run_week, check_seq, check_name, metric, item_kind, (position - 1) // 2 AS chunk, COUNT(*) AS n_items, string_agg(text, '; ' ORDER BY position) AS text "
        "FROM items GROUP BY ALL"
    )
    sql["drift_frequency_daily"] = (
        "SELECT 'orders_daily' AS dashboard, split_part(day, '-', 1) || '-Q' || ((CAST(split_part(day, '-', 2) AS INTEGER) + 2) // 3) AS quarter, 'trend_sanity' AS check_name, "
        "COUNT(*) AS n_runs, COUNT(*) AS n_checks, COUNT(*) FILTER (WHERE status = 'DRIFT') AS n_drift, COUNT(*) FILTER (WHERE status = 'FAIL') AS n_fail "
        f"FROM ({_day_trend_sql()}) GROUP BY ALL"
    )
    sql["failed_runs"] = f1 + "SELECT 'events_dashboard' AS dashboard, run_week, fail AS n_fail FROM summary WHERE fail > 0"
    return sql
