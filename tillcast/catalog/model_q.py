"""Regression, residual and uncertainty/routing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.drift_q import filled, filled_sql
from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import rows, w, with_panel
from tillcast.operators import filters as B
from tillcast.operators import profile as G
from tillcast.operators import regression as R
from tillcast.operators import splits as V
from tillcast.operators import uncertainty as U
from tillcast.operators import windows as W
from tillcast.plans.training import FEATURES, model_frames
from tillcast.sources.tables import store_panel

OPEN = 'o AS (SELECT * FROM panel WHERE "Open" = 1)'


# ---------------------------------------------------------------- L1 simple, R1, R2
def _simple_fit(spark, sf):
    o = B.drop_closed(store_panel(spark, sf, materialize=True), keep_flag=True)
    c = o.agg(F.regr_slope("Sales", "Customers").alias("slope"), F.regr_intercept("Sales", "Customers").alias("intercept"),
              F.regr_r2("Sales", "Customers").alias("r2"), F.regr_count("Sales", "Customers").alias("n")).first()
    return o, c


@query("ols_simple", with_panel(OPEN) + f"""
SELECT {srnd('regr_slope("Sales", "Customers")', 4)} AS slope, {srnd('regr_intercept("Sales", "Customers")', 4)} AS intercept,
       {srnd('regr_r2("Sales", "Customers")', 6)} AS r2, CAST(regr_count("Sales", "Customers") AS BIGINT) AS n FROM o""")
def q_ols_simple(spark, sf):
    o = B.drop_closed(store_panel(spark, sf), keep_flag=True)
    c = o.agg(F.regr_slope("Sales", "Customers").alias("slope"), F.regr_intercept("Sales", "Customers").alias("intercept"),
              F.regr_r2("Sales", "Customers").alias("r2"), F.regr_count("Sales", "Customers").alias("n"))
    return c.select(rnd("slope", 4).alias("slope"), rnd("intercept", 4).alias("intercept"), rnd("r2", 6).alias("r2"), "n")


_FIT_SQL = """fit AS (SELECT regr_slope("Sales", "Customers") AS b1, regr_intercept("Sales", "Customers") AS b0 FROM o)"""


def _residuals(spark, sf):
    o, c = _simple_fit(spark, sf)
    pred = o.withColumn("p", F.lit(c["intercept"]) + F.lit(c["slope"]) * F.col("Customers")).withColumnRenamed("Sales", "y")
    return R.residual_table(pred, keys=("Store", "Date"))


@query("residuals", with_panel(OPEN, _FIT_SQL) + f"""
SELECT "Store", "Date", {srnd('b0 + b1 * "Customers"')} AS fitted, {srnd('"Sales" - (b0 + b1 * "Customers")')} AS residual,
       "Sales" AS actual FROM o, fit""")
def q_residuals(spark, sf):
    r = _residuals(spark, sf)
    return r.select("Store", "Date", rnd("fitted").alias("fitted"), rnd("residual").alias("residual"), "actual")


@query("residual_hist", with_panel(OPEN, _FIT_SQL, 'src AS (SELECT "Sales" - (b0 + b1 * "Customers") AS x FROM o, fit)',
                                   "r AS (SELECT min(x) AS lo, max(x) AS hi FROM src)",
                                   """c AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((x - r.lo) * 50 / (r.hi - r.lo)), 49) END AS INTEGER) AS bin,
                                          count(*) AS n FROM src, r WHERE x IS NOT NULL GROUP BY 1)""",
                                   "g AS (SELECT CAST(unnest(range(0, 50)) AS INTEGER) AS bin)") + f"""
SELECT g.bin, {srnd('r.lo + g.bin * (r.hi - r.lo) / 50', 4)} AS bin_lo, {srnd('r.lo + (g.bin + 1) * (r.hi - r.lo) / 50', 4)} AS bin_hi,
       coalesce(c.n, 0) AS "count" FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin WHERE r.lo IS NOT NULL""")
def q_residual_hist(spark, sf):
    h = G.histogram(_residuals(spark, sf), "residual", 50)
    return h.select("bin", rnd("bin_lo", 4).alias("bin_lo"), rnd("bin_hi", 4).alias("bin_hi"), "count")


def _qq_sql(points: int = 199):
    from tillcast.functions.scalars import normal_quantile_sql
    probs = ", ".join(repr((i + 0.5) / points) for i in range(points))
    prob = f"((CAST(0.5 AS DOUBLE) + CAST(i AS DOUBLE)) / CAST({points} AS DOUBLE))"
    return with_panel(OPEN, _FIT_SQL, 'src AS (SELECT "Sales" - (b0 + b1 * "Customers") AS x FROM o, fit)',
                      f"qs AS (SELECT quantile_cont(x, [{probs}]) AS q FROM src)",
                      f"g AS (SELECT CAST(i AS INTEGER) - 1 AS i, q[i] AS sample FROM qs, range(1, {points + 1}) t(i))",
                      f"gp AS (SELECT i, {prob} AS prob, sample FROM g)",
                      f"gt AS (SELECT prob, sample, {normal_quantile_sql('prob')} AS theoretical FROM gp)",
                      "fl AS (SELECT regr_slope(sample, theoretical) AS slope, regr_intercept(sample, theoretical) AS intercept,"
                      " corr(sample, theoretical) AS r FROM gt)") + f"""
SELECT {srnd('prob', 6)} AS prob, {srnd('theoretical', 6)} AS theoretical, {srnd('sample', 4)} AS sample,
       {srnd('slope', 4)} AS slope, {srnd('intercept', 4)} AS intercept, {srnd('r', 6)} AS r FROM gt, fl"""


@query("qq_grid", _qq_sql())
def q_qq_grid(spark, sf):
    g = R.qq_grid(_residuals(spark, sf), "residual")
    return g.select(rnd("prob", 6).alias("prob"), rnd("theoretical", 6).alias("theoretical"), rnd("sample", 4).alias("sample"),
                    rnd("slope", 4).alias("slope"), rnd("intercept", 4).alias("intercept"), rnd("r", 6).alias("r"))


# ---------------------------------------------------------------- L1-L8 on the 29-feature matrix
def _frames(spark, sf):
    return model_frames(store_panel(spark, sf))


def _coef_table(spark, m: R.Fitted):
    rows = [("(intercept)", float(m.model.intercept))] + list(zip(m.features, [float(v) for v in m.model.coefficients]))
    return spark.createDataFrame(rows, "feature string, coef double")  # model parameters, one row per feature


@query("ols_fit")
def q_ols_fit(spark, sf):
    md = _frames(spark, sf)
    return _coef_table(spark, R.fit(md.train, FEATURES, R.MODEL_SPECS["LinearRegression"]))


@query("ridge_fit")
def q_ridge_fit(spark, sf):
    md = _frames(spark, sf)
    return _coef_table(spark, R.fit(md.train, FEATURES, R.MODEL_SPECS["Ridge (L2)"]))


@query("lasso_fit")
def q_lasso_fit(spark, sf):
    md = _frames(spark, sf)
    return _coef_table(spark, R.fit(md.train, FEATURES, R.MODEL_SPECS["Lasso (L1)"]))


@query("enet_fit")
def q_enet_fit(spark, sf):
    md = _frames(spark, sf)
    return _coef_table(spark, R.fit(md.train, FEATURES, R.MODEL_SPECS["ElasticNet"]))


@query("gbt_fit")
def q_gbt_fit(spark, sf):
    """The 200-tree boosted model (accurate tier): test-set predictions."""
    md = _frames(spark, sf)
    m = R.fit(md.train, FEATURES, R.ACCURATE_SPEC)
    return m.predict(md.test).select("key_store", "key_date", "y", "p")


@query("ts_cv")
def q_ts_cv(spark, sf):
    md = _frames(spark, sf)
    cv = R.ts_cv(md.train, FEATURES, R.MODEL_SPECS["Ridge (L2)"], 5)
    rows = [(i, v) for i, v in enumerate(cv["cv_rmse_folds"])]
    return spark.createDataFrame(rows, "fold int, rmse double")


@query("model_compare")
def q_model_compare(spark, sf):
    """All five models with 5-fold expanding CV, each as its spec has it."""
    md = _frames(spark, sf)
    return R.model_compare(md.train, md.test, FEATURES, R.MODEL_SPECS, cv_folds=5)


@query("importance")
def q_importance(spark, sf):
    md = _frames(spark, sf)
    return R.importance_table(R.fit(md.train, FEATURES, R.MODEL_SPECS["Ridge (L2)"]), 20)


@query("importance_tree")
def q_importance_tree(spark, sf):
    """Importances of the 200-tree boosted model."""
    md = _frames(spark, sf)
    return R.importance_table(R.fit(md.train, FEATURES, R.ACCURATE_SPEC), 20)


@query("learning_curve")
def q_learning_curve(spark, sf):
    md = _frames(spark, sf)
    return R.learning_curve(md.train, FEATURES, R.MODEL_SPECS["Ridge (L2)"])


# ---------------------------------------------------------------- U1-U3 bootstrap
@query("bootstrap_fit")
def q_bootstrap_fit(spark, sf):
    md = _frames(spark, sf)
    ens = U.bootstrap_fit(md.train, FEATURES, 30)
    rows = [(i, b0, c) for i, (b0, c) in enumerate(zip(ens.intercepts, ens.coefs))]
    return spark.createDataFrame(rows, "replica int, intercept double, coef array<double>")


@query("bootstrap_interval")
def q_bootstrap_interval(spark, sf):
    md = _frames(spark, sf)
    ens = U.bootstrap_fit(md.train, FEATURES, 30)
    out = U.interval(ens.predictions(md.test))
    return out.select("key_store", "key_date", "y", "mean_pred", "std_pred", "lower", "upper")


# ---------------------------------------------------------------- U2-U7 over a forecaster ensemble (SQL-checkable)
_ENS = ["lag_7", "lag_14", "lag_30", "rolling_mean_7", "rolling_mean_30"]
_LO_Q, _HI_Q = (1 - 0.90) / 2, (1 + 0.90) / 2


def _ensemble(spark, sf):
    p = store_panel(spark, sf, materialize=True)
    f = W.rolling_mean(W.lag_features(p), windows=(7, 30))
    cut = V.cutoff_date(f, 3)
    f = filled(f, _ENS)
    f = f.select(F.col("Store").alias("key_store"), F.col("Date").alias("key_date"), F.col("Sales").alias("y"),
                 F.array(*_ENS).alias("preds"), F.col("rolling_mean_7").alias("p_fast"),
                 F.col("rolling_mean_30").alias("p_accurate"), (F.col("Date") > cut).alias("is_test"))
    return U.interval(f)


def _pct_sql(q):
    pos = f"({q!r} * (len(preds) - 1))"
    lo = f"CAST(floor({pos}) AS INTEGER)"
    hi = f"least({lo} + 1, len(preds) - 1)"
    s = "list_sort(preds)"
    return f"({s}[{lo} + 1] + ({s}[{hi} + 1] - {s}[{lo} + 1]) * ({pos} - {lo}))"


_ENS_SQL = with_panel(
    'cut AS (SELECT CAST(max("Date") - INTERVAL 3 MONTH AS DATE) AS c FROM panel)',
    f"""f AS (SELECT *, lag("Sales", 7) OVER {w()} AS lag_7, lag("Sales", 14) OVER {w()} AS lag_14,
        lag("Sales", 30) OVER {w()} AS lag_30, avg("Sales") OVER {w(rows(-7, -1))} AS rolling_mean_7,
        avg("Sales") OVER {w(rows(-30, -1))} AS rolling_mean_30 FROM panel)""",
    "g AS (SELECT * REPLACE (" + ", ".join(f"{filled_sql(c, 'f')} AS {c}" for c in _ENS) + """) FROM f WHERE "Open" = 1)""",
    f"""e AS (SELECT "Store" AS key_store, "Date" AS key_date, "Sales" AS y, [{", ".join(_ENS)}] AS preds,
        rolling_mean_7 AS p_fast, rolling_mean_30 AS p_accurate, "Date" > (SELECT c FROM cut) AS is_test FROM g)""",
    "m AS (SELECT *, list_sum(preds) / len(preds) AS mean_pred FROM e)",
    f"""i AS (SELECT *, sqrt(list_sum(list_transform(preds, lambda x: (x - mean_pred) * (x - mean_pred))) / len(preds)) AS std_pred,
        {_pct_sql(_LO_Q)} AS lower, {_pct_sql(_HI_Q)} AS upper FROM m)""",
    "t AS (SELECT quantile_cont(std_pred, 0.8) AS thr FROM i WHERE is_test)",
    """rt AS (SELECT i.*, std_pred > (SELECT thr FROM t) AS use_accurate,
        CASE WHEN std_pred > (SELECT thr FROM t) THEN p_accurate ELSE p_fast END AS prediction FROM i WHERE is_test)""")


def _routed(spark, sf):
    e = _ensemble(spark, sf)
    test = e.where("is_test")
    return U.route(test, U.fit_threshold(test, "std_pred", 80.0))


@query("array_interval", _ENS_SQL + f"""
SELECT key_store, key_date, {srnd('mean_pred')} AS mean_pred, {srnd('std_pred')} AS std_pred,
       {srnd('lower')} AS lower, {srnd('upper')} AS upper FROM i""")
def q_array_interval(spark, sf):
    e = _ensemble(spark, sf)
    return e.select("key_store", "key_date", *[rnd(c).alias(c) for c in ("mean_pred", "std_pred", "lower", "upper")])


@query("route_threshold", _ENS_SQL + f"SELECT {srnd('thr')} AS threshold FROM t")
def q_route_threshold(spark, sf):
    e = _ensemble(spark, sf).where("is_test")
    thr = U.fit_threshold(e, "std_pred", 80.0)
    return spark.range(1).select(rnd(F.lit(thr)).alias("threshold"))


@query("route", _ENS_SQL + f"""
SELECT key_store, key_date, y, {srnd('std_pred')} AS std_pred, use_accurate, {srnd('prediction')} AS prediction FROM rt""")
def q_route(spark, sf):
    r = _routed(spark, sf)
    return r.select("key_store", "key_date", "y", rnd("std_pred").alias("std_pred"), "use_accurate",
                    rnd("prediction").alias("prediction"))


@query("routing_stats", _ENS_SQL + f"""
SELECT count(*) AS total_samples, {srnd('avg(CASE WHEN use_accurate THEN 0.0 ELSE 1.0 END) * 100', 6)} AS fast_model_pct,
       {srnd('avg(CASE WHEN use_accurate THEN 1.0 ELSE 0.0 END) * 100', 6)} AS accurate_model_pct,
       {srnd('avg(std_pred)')} AS mean_uncertainty, {srnd('quantile_cont(std_pred, 0.9)')} AS p90_uncertainty FROM rt""")
def q_routing_stats(spark, sf):
    s = U.routing_stats(_routed(spark, sf))
    return s.select("total_samples", rnd("fast_model_pct", 6).alias("fast_model_pct"),
                    rnd("accurate_model_pct", 6).alias("accurate_model_pct"),
                    rnd("mean_uncertainty").alias("mean_uncertainty"), rnd("p90_uncertainty").alias("p90_uncertainty"))


@query("interval_table", _ENS_SQL + f"""
SELECT key_store, key_date, y, {srnd('mean_pred')} AS mean_pred, {srnd('lower')} AS lower, {srnd('upper')} AS upper,
       use_accurate FROM rt ORDER BY y, key_store, key_date LIMIT 200""")
def q_interval_table(spark, sf):
    t = U.interval_table(_routed(spark, sf), 200)
    return t.select("key_store", "key_date", "y", rnd("mean_pred").alias("mean_pred"), rnd("lower").alias("lower"),
                    rnd("upper").alias("upper"), "use_accurate")
