"""Metrics, VIF and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import rows, w, with_panel
from tillcast.operators import drift as M
from tillcast.operators import filters as B
from tillcast.operators import ordering as D
from tillcast.operators import splits as V
from tillcast.operators import stats as G
from tillcast.operators import windows as W
from tillcast.session import cut_lineage
from tillcast.sources.tables import read_table, store_panel

CUT = 'cut AS (SELECT CAST(max("Date") - INTERVAL 3 MONTH AS DATE) AS c FROM panel)'
FEAT = f"""feat AS (SELECT *, lag("Sales", 7) OVER {w()} AS lag_7,
    avg("Sales") OVER {w(rows(-7, -1))} AS rolling_mean_7,
    avg("Sales") OVER {w(rows(-30, -1))} AS rolling_mean_30,
    coalesce(stddev_samp("Sales") OVER {w(rows(-7, -1))}, 0) AS rolling_std_7,
    CASE WHEN count("Sales") OVER {w(rows(-30, -1))} = 30
         THEN coalesce(regr_slope("Sales", rn) OVER {w(rows(-30, -1))}, 0) ELSE 0 END AS trend_slope_30d
  FROM (SELECT *, CAST(row_number() OVER {w()} AS DOUBLE) AS rn FROM panel))"""
MODELS = (("naive_lag7", "lag_7"), ("mean_7", "rolling_mean_7"), ("mean_30", "rolling_mean_30"))


def filled_sql(c: str, source: str = "feat") -> str:
    """Column ``c`` with the median of the open days where it is missing (a store's first days)."""
    return f'coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM {source} WHERE "Open" = 1))'


def filled(df, cols):
    """Open days, with each column's median where it is missing."""
    o = B.drop_closed(df, keep_flag=True)
    return B.fill_with(o, B.train_medians(o, cols), cols)


PRED = ("pr AS (" + " UNION ALL ".join(
    f"""SELECT '{m}' AS model, CASE WHEN "Date" <= (SELECT c FROM cut) THEN 'train' ELSE 'test' END AS split,
        "Sales" AS y, {filled_sql(c)} AS p FROM feat WHERE "Open" = 1""" for m, c in MODELS) + ")")


def _features(spark, sf):
    p = store_panel(spark, sf, materialize=True)
    f = W.rolling_mean(W.lag_features(p, lags=(7,)), windows=(7, 30))
    f = W.rolling_std(f, windows=(7,))
    return W.trend_slope(f)


def _predictions(spark, sf):
    """Long (model, split, y, p) table of baseline forecasters on open days."""
    f = filled(V.label_time_split(_features(spark, sf)), [c for _, c in MODELS])
    parts = [f.select(F.lit(m).alias("model"), "split", F.col("Sales").alias("y"), F.col(c).alias("p"))
             for m, c in MODELS]
    return D.union_reports(parts)


_METRIC_SQL = f"""count(*) AS n, {srnd('sqrt(avg((y - p) * (y - p)))')} AS "RMSE", {srnd('avg(abs(y - p))')} AS "MAE",
    {srnd('1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y))', 6)} AS "R2",
    {srnd('sqrt(avg(CASE WHEN y <> 0 THEN ((y - p) / y) * ((y - p) / y) END))', 6)} AS "RMSPE",
    {srnd('avg(abs((y - p) / (y + 1e-8))) * 100', 6)} AS "MAPE" """


def _round_metrics(df):
    return df.select(*[c for c in df.columns if c not in ("RMSE", "MAE", "R2", "RMSPE", "MAPE")],
                     rnd("RMSE").alias("RMSE"), rnd("MAE").alias("MAE"), rnd("R2", 6).alias("R2"),
                     rnd("RMSPE", 6).alias("RMSPE"), rnd("MAPE", 6).alias("MAPE"))


@query("metric_rmspe", with_panel(CUT, FEAT, PRED) + f"""
SELECT model, {srnd('sqrt(avg(CASE WHEN y <> 0 THEN ((y - p) / y) * ((y - p) / y) END))', 6)} AS "RMSPE"
FROM pr WHERE split = 'test' GROUP BY model""")
def q_metric_rmspe(spark, sf):
    pr = _predictions(spark, sf).where(F.col("split") == "test")
    return G.rmspe(pr, by=["model"]).select("model", rnd("RMSPE", 6).alias("RMSPE"))


@query("metrics_all", with_panel(CUT, FEAT, PRED) + f"SELECT model, split, {_METRIC_SQL} FROM pr GROUP BY model, split")
def q_metrics_all(spark, sf):
    return _round_metrics(G.regression_metrics(_predictions(spark, sf), by=["model", "split"]))


@query("union_reports", with_panel(CUT, FEAT, PRED) + f"""
SELECT model, 'train' AS split, {_METRIC_SQL} FROM pr WHERE split = 'train' GROUP BY model
UNION ALL SELECT model, 'test' AS split, {_METRIC_SQL} FROM pr WHERE split = 'test' GROUP BY model""")
def q_union_reports(spark, sf):
    pr = _predictions(spark, sf)
    parts = [G.regression_metrics(pr.where(F.col("split") == s), by=["model"]).withColumn("split", F.lit(s))
             for s in ("train", "test")]
    return _round_metrics(D.union_reports(parts))


@query("best_by_metric", with_panel(CUT, FEAT, PRED, f"m AS (SELECT model, {_METRIC_SQL.replace('round(', 'round(').replace(', 6)', ', 6)')} FROM pr WHERE split = 'test' GROUP BY model)") + """
SELECT * FROM m ORDER BY "RMSPE", model LIMIT 1""")
def q_best_by_metric(spark, sf):
    pr = _predictions(spark, sf).where(F.col("split") == "test")
    m = G.regression_metrics(pr, by=["model"])
    return _round_metrics(D.best_by(m, "RMSPE"))


# ---------------------------------------------------------------- VIF
_VIF3 = ("lag_7", "rolling_mean_7", "rolling_mean_30")


def _vif_sql(uncentered: bool):
    a, b, c = _VIF3
    src = f"(SELECT {a}, {b}, {c} FROM feat WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {c} IS NOT NULL)"
    if not uncentered:
        stats = f"s AS (SELECT corr({a}, {b}) AS r12, corr({a}, {c}) AS r13, corr({b}, {c}) AS r23 FROM {src})"
        det = "(1 - r12 * r12 - r13 * r13 - r23 * r23 + 2 * r12 * r13 * r23)"
        body = " UNION ALL ".join([
            f"SELECT '{a}' AS feature, {srnd(f'(1 - r23 * r23) / {det}', 4)} AS \"VIF\" FROM s",
            f"SELECT '{b}', {srnd(f'(1 - r13 * r13) / {det}', 4)} FROM s",
            f"SELECT '{c}', {srnd(f'(1 - r12 * r12) / {det}', 4)} FROM s"])
    else:
        stats = (f"s AS (SELECT sum({a} * {a}) AS m11, sum({a} * {b}) AS m12, sum({a} * {c}) AS m13, "
                 f"sum({b} * {b}) AS m22, sum({b} * {c}) AS m23, sum({c} * {c}) AS m33 FROM {src})")
        det = "(m11 * (m22 * m33 - m23 * m23) - m12 * (m12 * m33 - m23 * m13) + m13 * (m12 * m23 - m22 * m13))"
        body = " UNION ALL ".join([
            f"SELECT '{a}' AS feature, {srnd(f'm11 * (m22 * m33 - m23 * m23) / {det}', 4)} AS \"VIF\" FROM s",
            f"SELECT '{b}', {srnd(f'm22 * (m11 * m33 - m13 * m13) / {det}', 4)} FROM s",
            f"SELECT '{c}', {srnd(f'm33 * (m11 * m22 - m12 * m12) / {det}', 4)} FROM s"])
    return with_panel(FEAT, stats) + body


@query("vif", _vif_sql(False))
def q_vif(spark, sf):
    return G.vif(_features(spark, sf), _VIF3).select("feature", rnd("VIF", 4).alias("VIF"))


@query("vif_uncentered", _vif_sql(True))
def q_vif_uncentered(spark, sf):
    return G.vif(_features(spark, sf), _VIF3, intercept=False).select("feature", rnd("VIF", 4).alias("VIF"))


_VIF_ALL = ["Promo", "SchoolHoliday", "DayOfWeek", "CompetitionDistance", "lag_7", "rolling_mean_7",
            "rolling_mean_30", "rolling_std_7", "trend_slope_30d"]


@query("vif_drop")
def q_vif_drop(spark, sf):
    return G.vif_drop(_features(spark, sf), _VIF_ALL, threshold=10.0)


# ---------------------------------------------------------------- PSI / KS
_PSI_FEATURES = ["Sales", "Customers", "Promo", "SchoolHoliday", "DayOfWeek", "CompetitionDistance",
                 "lag_7", "rolling_mean_7", "rolling_std_7", "trend_slope_30d"]
_LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LI_SPLIT = "1999-01-01"


def _psi_sql(ctes, src, side_expr, features, guard=True):
    probs = ", ".join(f"{i / 10}" for i in range(11))
    long = "long AS (" + " UNION ALL ".join(
        f"SELECT {side_expr} AS side, '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value FROM {src} WHERE \"{c}\" IS NOT NULL"
        for c in features) + ")"
    body = [long,
            """sz AS (SELECT feature, count(*) FILTER (WHERE side = 'ref') AS n_ref,
                   count(*) FILTER (WHERE side = 'cur') AS n_cur FROM long GROUP BY 1)""",
            f"""bp AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS bp
                   FROM long WHERE side = 'ref' GROUP BY 1)""",
            """b AS (SELECT l.feature, l.side, CASE WHEN len(bp) < 2 THEN NULL
                   WHEN l.value < bp[1] OR l.value > bp[len(bp)] THEN NULL
                   WHEN l.value = bp[len(bp)] THEN len(bp) - 2
                   ELSE len(list_filter(bp, lambda x: x <= l.value)) - 1 END AS bin
                   FROM long l JOIN bp ON l.feature = bp.feature)""",
            "c AS (SELECT feature, side, bin, count(*) AS n FROM b WHERE bin IS NOT NULL GROUP BY ALL)",
            """g AS (SELECT feature, unnest(range(0, len(bp) - 1)) AS bin FROM bp WHERE len(bp) >= 2)""",
            """gs AS (SELECT g.feature, g.bin, s.side FROM g CROSS JOIN (VALUES ('ref'), ('cur')) s(side))""",
            """cc AS (SELECT gs.feature, gs.bin, gs.side, CAST(coalesce(c.n, 0) AS DOUBLE) + 1e-6 AS c
                   FROM gs LEFT JOIN c ON gs.feature = c.feature AND gs.bin = c.bin AND gs.side = c.side)""",
            "pc AS (SELECT feature, bin, side, c / sum(c) OVER (PARTITION BY feature, side) AS pct FROM cc)",
            """ps AS (SELECT r.feature, sum((u.pct - r.pct) * ln(u.pct / r.pct)) AS psi FROM pc r JOIN pc u
                   ON r.feature = u.feature AND r.bin = u.bin AND r.side = 'ref' AND u.side = 'cur' GROUP BY 1)"""]
    where = "WHERE n_ref >= 10 AND n_cur >= 10" if guard else ""
    return with_panel(*ctes, *body) + f"""
SELECT sz.feature, {srnd('coalesce(ps.psi, 0.0)', 6)} AS "PSI",
       CASE WHEN coalesce(ps.psi, 0.0) > 0.25 THEN 'CRITICAL' WHEN coalesce(ps.psi, 0.0) > 0.10 THEN 'WARNING' ELSE 'OK' END AS status
FROM sz LEFT JOIN ps ON sz.feature = ps.feature {where}"""


def _panel_sides(spark, sf):
    """Both sides of the time split; written once, since PSI reads its input in passes."""
    f = B.drop_closed(V.label_time_split(_features(spark, sf)), keep_flag=True)
    f = cut_lineage(f.select("split", *_PSI_FEATURES))
    return f.where(F.col("split") == "train"), f.where(F.col("split") == "test")


def _lineitem_long(spark, sf, features):
    """Reference = shipped before the split date, current = after; one scan."""
    li = read_table(spark, sf, "lineitem", [*features, "l_shipdate"])
    return M.labelled(li, F.col("l_shipdate") < F.lit(_LI_SPLIT).cast("timestamp_ntz"), features)


_PANEL_PSI_SQL = _psi_sql([CUT, FEAT], 'feat WHERE "Open" = 1 AND',
                          """CASE WHEN "Date" <= (SELECT c FROM cut) THEN 'ref' ELSE 'cur' END""", _PSI_FEATURES)
_PANEL_PSI_SQL = _PANEL_PSI_SQL.replace("WHERE \"Open\" = 1 AND WHERE", "WHERE \"Open\" = 1 AND")


@query("psi_report", _PANEL_PSI_SQL)
def q_psi_report(spark, sf):
    ref, cur = _panel_sides(spark, sf)
    r = M.psi_report(ref, cur, _PSI_FEATURES)
    return r.select("feature", rnd("PSI", 6).alias("PSI"), "status")


# days after a week of low sales (reference) and of high sales: the week's other measures differ
_WEAK_WEEK = 200_000
_WEEK_SQL = _psi_sql([FEAT], 'feat WHERE "Open" = 1 AND rolling_mean_7 IS NOT NULL AND',
                     f"CASE WHEN rolling_mean_7 <= {_WEAK_WEEK} THEN 'ref' ELSE 'cur' END", _PSI_FEATURES)
_WEEK_SQL = _WEEK_SQL.replace("IS NOT NULL AND WHERE", "IS NOT NULL AND")


@query("psi_status_filter", "SELECT * FROM (" + _WEEK_SQL + ") WHERE status IN ('WARNING', 'CRITICAL')")
def q_psi_status_filter(spark, sf):
    f = B.drop_closed(_features(spark, sf), keep_flag=True).where(F.col("rolling_mean_7").isNotNull())
    sides = cut_lineage(M.labelled(f, F.col("rolling_mean_7") <= _WEAK_WEEK, _PSI_FEATURES))
    r = B.filter_isin(M.psi_report(sides, None, _PSI_FEATURES), "status", ["WARNING", "CRITICAL"])
    return r.select("feature", rnd("PSI", 6).alias("PSI"), "status")


_LI_SRC = "(SELECT * FROM lineitem) li WHERE"
_LI_SIDE = f"CASE WHEN l_shipdate < TIMESTAMP '{_LI_SPLIT}' THEN 'ref' ELSE 'cur' END"


@query("psi_single", _psi_sql([], _LI_SRC, _LI_SIDE, ["l_extendedprice"]).replace("li WHERE WHERE", "li WHERE"))
def q_psi_single(spark, sf):
    r = M.psi_report(_lineitem_long(spark, sf, ["l_extendedprice"]), None, ["l_extendedprice"])
    return r.select("feature", rnd("PSI", 6).alias("PSI"), "status")


def _ks_sql(prefix="WITH ", src="lineitem", side=None, features=None):
    side = side or _LI_SIDE
    features = features or _LI_FEATURES
    long = "long AS (" + " UNION ALL ".join(
        f"SELECT {side} AS side, '{c}' AS feature, CAST(\"{c}\" AS DOUBLE) AS value FROM {src} \"{c}\" IS NOT NULL"
        for c in features) + ")"
    lam = "sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) * d"
    series = f"list_sum(list_transform(range(1, 101), lambda k: 2.0 * CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * ({lam}) * ({lam}))))"
    pv = f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END"
    return (prefix + long + """,
    c AS (SELECT feature, value, count(*) FILTER (WHERE side = 'ref') AS c_ref,
          count(*) FILTER (WHERE side = 'cur') AS c_cur FROM long GROUP BY 1, 2),
    cu AS (SELECT feature, sum(c_ref) OVER (PARTITION BY feature ORDER BY value) AS cr,
          sum(c_cur) OVER (PARTITION BY feature ORDER BY value) AS cc,
          sum(c_ref) OVER (PARTITION BY feature) AS nr, sum(c_cur) OVER (PARTITION BY feature) AS nc FROM c),
    k AS (SELECT feature, CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nc) AS BIGINT) AS n_cur,
          max(abs(CAST(cr AS DOUBLE) / nr - CAST(cc AS DOUBLE) / nc)) AS d FROM cu GROUP BY 1)
    """ + f"""SELECT feature, n_ref, n_cur, {srnd('d', 6)} AS "KS_stat", {srnd(pv, 6)} AS p_value, ({pv}) < 0.05 AS drift
    FROM k WHERE n_ref >= 10 AND n_cur >= 10""")


@query("ks_stat", _ks_sql(src="lineitem WHERE"))
def q_ks_stat(spark, sf):
    k = M.ks_report(_lineitem_long(spark, sf, _LI_FEATURES), None, _LI_FEATURES)
    return k.select("feature", "n_ref", "n_cur", rnd("KS_stat", 6).alias("KS_stat"),
                    rnd("p_value", 6).alias("p_value"), "drift")


# ---------------------------------------------------------------- CUSUM
_BASE, _KF, _THR = 45.0, 0.1, 5.0


def _events_batches(spark, sf):
    ev = read_table(spark, sf, "events", ["event_type", "ts", "value"])
    return M.residual_batches(ev, "event_type", F.to_date("ts"), F.col("value") - F.lit(_BASE))


_EVENT_BATCHES = f"""b AS (SELECT event_type AS entity, CAST(ts AS DATE) AS batch, avg(value - {_BASE}) AS m,
        stddev_pop(value - {_BASE}) AS s, count(value - {_BASE}) AS n FROM events GROUP BY 1, 2)"""


def _cusum_sql(batches: str = f"WITH RECURSIVE {_EVENT_BATCHES}", kf: float = _KF):
    def step(pp, nn):
        p = f"greatest(0.0, ({pp} + bi.m) - {kf} * bi.s)"
        n = f"greatest(0.0, ({nn} - bi.m) - {kf} * bi.s)"
        return f"""CASE WHEN {p} > {_THR} THEN 0.0 ELSE {p} END AS pos,
            CASE WHEN {p} > {_THR} THEN {n} WHEN {n} > {_THR} THEN 0.0 ELSE {n} END AS neg,
            CASE WHEN {p} > {_THR} THEN 'POSITIVE_DRIFT' WHEN {n} > {_THR} THEN 'NEGATIVE_DRIFT' END AS alert,
            CASE WHEN {p} > {_THR} THEN {p} WHEN {n} > {_THR} THEN {n} END AS alert_value"""
    return f"""{batches},
    bi AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY batch) AS i FROM b),
    r AS (SELECT bi.entity, bi.i, bi.batch, bi.m, bi.s, bi.n, {step('0.0', '0.0')} FROM bi WHERE bi.i = 1
          UNION ALL
          SELECT bi.entity, bi.i, bi.batch, bi.m, bi.s, bi.n, {step('r.pos', 'r.neg')}
          FROM r JOIN bi ON bi.entity = r.entity AND bi.i = r.i + 1)"""


@query("cusum_batch", _cusum_sql() + f"""
SELECT entity, batch, {srnd('m', 6)} AS mean_residual, {srnd('s', 6)} AS std_residual, n AS n_samples,
       {srnd('pos', 6)} AS cusum_pos, {srnd('neg', 6)} AS cusum_neg, alert, {srnd('alert_value', 6)} AS alert_value FROM r""")
def q_cusum_batch(spark, sf):
    c = M.cusum(_events_batches(spark, sf), threshold=_THR, k_factor=_KF)
    return c.select("entity", "batch", *[rnd(x, 6).alias(x) for x in ("mean_residual", "std_residual")], "n_samples",
                    rnd("cusum_pos", 6).alias("cusum_pos"), rnd("cusum_neg", 6).alias("cusum_neg"), "alert",
                    rnd("alert_value", 6).alias("alert_value"))


@query("monitor_summary", _cusum_sql() + f""",
    rk AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY batch DESC) AS k FROM r)
SELECT entity, count(*) AS total_batches, {srnd('avg(m)', 6)} AS overall_mean_residual,
       {srnd('avg(CASE WHEN k <= 7 THEN m END)', 6)} AS recent_mean_residual, count(alert) AS total_alerts,
       arg_max(alert, batch) FILTER (WHERE alert IS NOT NULL) AS last_alert_type,
       max(batch) FILTER (WHERE alert IS NOT NULL) AS last_alert_batch
FROM rk GROUP BY entity""")
def q_monitor_summary(spark, sf):
    c = M.cusum(_events_batches(spark, sf), threshold=_THR, k_factor=_KF)
    s = M.monitor_summary(c, 7)
    return s.select("entity", "total_batches", rnd("overall_mean_residual", 6).alias("overall_mean_residual"),
                    rnd("recent_mean_residual", 6).alias("recent_mean_residual"), "total_alerts",
                    "last_alert_type", "last_alert_batch")


_LAG_7 = filled_sql("lag_7")


@query("residual_monthly", with_panel(FEAT) + f"""
SELECT CAST(date_trunc('month', "Date") AS DATE) AS "month", {srnd(f'avg("Sales" - {_LAG_7})')} AS mean_residual,
       abs(avg("Sales" - {_LAG_7})) > 500 AS flagged
FROM feat WHERE "Open" = 1 GROUP BY 1""")
def q_residual_monthly(spark, sf):
    f = filled(_features(spark, sf), ["lag_7"])
    m = M.residual_monthly(f, "Date", F.col("Sales") - F.col("lag_7"))
    return m.select("month", rnd("mean_residual").alias("mean_residual"), "flagged")


@query("cusum_stream", _cusum_sql() + f"""
SELECT entity, batch, {srnd('m', 6)} AS mean_residual, {srnd('s', 6)} AS std_residual, n AS n_samples,
       {srnd('pos', 6)} AS cusum_pos, {srnd('neg', 6)} AS cusum_neg, alert, {srnd('alert_value', 6)} AS alert_value
FROM r WHERE batch + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def q_cusum_stream(spark, sf):
    """M5: the online monitor over the events table as a file stream. A day is
    emitted once the watermark (latest event - 1 hour) passes its end, so the
    result equals the batch fold over the closed days."""
    from tillcast.streaming.cusum_stream import cusum_stream, event_stream, run_to_table
    schema = read_table(spark, sf, "events", ["event_type", "ts", "value"]).schema
    ev = event_stream(spark, sf, schema, "events.parquet")
    s = cusum_stream(ev, "event_type", "ts", F.col("value") - F.lit(_BASE), threshold=_THR, k_factor=_KF,
                     watermark="1 hour")
    c = run_to_table(spark, s)
    return c.select("entity", "batch", *[rnd(x, 6).alias(x) for x in ("mean_residual", "std_residual")], "n_samples",
                    rnd("cusum_pos", 6).alias("cusum_pos"), rnd("cusum_neg", 6).alias("cusum_neg"), "alert",
                    rnd("alert_value", 6).alias("alert_value"))


@query("drift_alerts", _cusum_sql() + """
SELECT entity, alert AS type,
       'Residuals drift ' || CASE WHEN alert = 'POSITIVE_DRIFT' THEN 'up' ELSE 'down' END || ': sum ' || printf('%.2f', alert_value) AS message,
       CAST(batch AS VARCHAR) AS timestamp,
       round(CASE WHEN alert = 'POSITIVE_DRIFT' THEN alert_value END + 1e-11, 6) AS cusum_pos,
       round(CASE WHEN alert = 'NEGATIVE_DRIFT' THEN alert_value END + 1e-11, 6) AS cusum_neg
FROM r WHERE alert IS NOT NULL""")
def q_drift_alerts(spark, sf):
    """A4: the alert records the monitor writes."""
    from tillcast.sources.sinks import alerts
    a = alerts(M.cusum(_events_batches(spark, sf), threshold=_THR, k_factor=_KF))
    return a.select("entity", "type", "message", "timestamp", rnd("cusum_pos", 6).alias("cusum_pos"),
                    rnd("cusum_neg", 6).alias("cusum_neg"))


@query("ks_report", _ks_sql(with_panel(CUT, FEAT) + ",\n", 'feat WHERE "Open" = 1 AND',
                            """CASE WHEN "Date" <= (SELECT c FROM cut) THEN 'ref' ELSE 'cur' END""", _PSI_FEATURES))
def q_ks_report(spark, sf):
    """M3 as used on the model inputs: train vs test of every monitored panel feature."""
    ref, cur = _panel_sides(spark, sf)
    k = M.ks_report(ref, cur, _PSI_FEATURES)
    return k.select("feature", "n_ref", "n_cur", rnd("KS_stat", 6).alias("KS_stat"),
                    rnd("p_value", 6).alias("p_value"), "drift")


# ---------------------------------------------------------------- composed flows
def _baseline_residuals(spark, sf):
    """Residuals of the lag-7 forecaster on all open days (missing lags at their median)."""
    o = B.drop_closed(_features(spark, sf), keep_flag=True)
    o = B.fill_with(o, B.train_medians(o, ["lag_7"]), ["lag_7"])
    return o.select("Store", "Date", (F.col("Sales") - F.col("lag_7")).alias("residual"))


_MONTH_BATCHES = with_panel(FEAT, 'o AS (SELECT * FROM feat WHERE "Open" = 1)', "med AS (SELECT quantile_cont(lag_7, 0.5) AS v FROM o)",
                            """b AS (SELECT CAST("Store" AS VARCHAR) AS entity, CAST(date_trunc('month', "Date") AS DATE) AS batch,
    avg("Sales" - coalesce(lag_7, v)) AS m, stddev_pop("Sales" - coalesce(lag_7, v)) AS s, count(*) AS n FROM o, med GROUP BY 1, 2)""")


@query("monitor_flow", _cusum_sql(_MONTH_BATCHES.replace("WITH ", "WITH RECURSIVE ", 1).rstrip(), 0.5) + f"""
SELECT entity, batch, {srnd('m')} AS mean_residual, {srnd('s')} AS std_residual, n AS n_samples,
       {srnd('pos')} AS cusum_pos, {srnd('neg')} AS cusum_neg, alert, {srnd('alert_value')} AS alert_value FROM r""")
def q_monitor_flow(spark, sf):
    """Forecast residuals -> monthly batches per store -> CUSUM with k = 0.5 std."""
    res = _baseline_residuals(spark, sf).withColumn("Store", F.col("Store").cast("string"))
    c = M.cusum(M.residual_batches(res, "Store", F.trunc("Date", "month"), F.col("residual")), threshold=_THR, k_factor=0.5)
    return c.select("entity", "batch", *[rnd(x).alias(x) for x in ("mean_residual", "std_residual")], "n_samples",
                    rnd("cusum_pos").alias("cusum_pos"), rnd("cusum_neg").alias("cusum_neg"), "alert", rnd("alert_value").alias("alert_value"))


@query("report_roundtrip", _PANEL_PSI_SQL)
def q_report_roundtrip(spark, sf):
    """A3: the PSI report written as JSON into the shared folder and read back."""
    import uuid

    from tillcast.session import ensure_checkpoint_dir
    from tillcast.sources.sinks import read_json_report, write_json
    ref, cur = _panel_sides(spark, sf)
    report = M.psi_report(ref, cur, _PSI_FEATURES).select("feature", "PSI", "status")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    write_json(report, path)
    return read_json_report(spark, path, report.schema).select("feature", rnd("PSI", 6).alias("PSI"), "status")


@query("vif_drop_collinear", with_panel(FEAT) + f"""
SELECT unnest(['lag_7', 'momentum', 'rolling_mean_7']) AS feature, unnest([true, false, false]) AS dropped,
       unnest([NULL, v, v]) AS "VIF"
FROM (SELECT {srnd('1 / (1 - power(corr(rolling_mean_7 - lag_7, rolling_mean_7), 2))', 4)} AS v FROM feat WHERE lag_7 IS NOT NULL AND rolling_mean_7 IS NOT NULL)""")
def q_vif_drop_collinear(spark, sf):
    """G20 on a linear combination (momentum = rolling_mean_7 - lag_7): all three are infinite, one goes."""
    f = _features(spark, sf).withColumn("momentum", F.col("rolling_mean_7") - F.col("lag_7"))
    f = f.where("lag_7 IS NOT NULL AND rolling_mean_7 IS NOT NULL")
    out = G.vif_drop(f, ["lag_7", "rolling_mean_7", "momentum"], threshold=1e6)
    return out.select("feature", "dropped", F.when(~F.col("dropped"), rnd("VIF", 4)).alias("VIF"))
