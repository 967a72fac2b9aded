"""Linear fits, folds and learning curves on two inputs, where SQL has a closed form.

The same functions run on the 29 inputs in ``model_q``; here the two inputs are
the lag and the weekly mean of every open day (missing values at their median).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tillcast.catalog.drift_q import _THR as MONITOR_LIMIT
from tillcast.catalog.drift_q import CUT, FEAT, _cusum_sql, _features
from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import with_panel
from tillcast.operators import boosting
from tillcast.operators import drift as M
from tillcast.operators import encoders as E
from tillcast.operators import filters as B
from tillcast.operators import regression as R
from tillcast.operators import splits as V
from tillcast.operators import uncertainty as U
from tillcast.operators.factors import segment_factors
from tillcast.session import cut_lineage
from tillcast.sources.tables import store_panel

TWO = ["lag_7", "rolling_mean_7"]
OLS, RIDGE, LASSO, ENET = (R.MODEL_SPECS[k] for k in ("LinearRegression", "Ridge (L2)", "Lasso (L1)", "ElasticNet"))
FOLDS, SIZES, CURVE_FOLDS = 5, 10, 3

X = ('o AS (SELECT "Store", "Date", "Sales" AS y, lag_7, rolling_mean_7 FROM feat WHERE "Open" = 1)',
     "med AS (SELECT quantile_cont(lag_7, 0.5) AS va, quantile_cont(rolling_mean_7, 0.5) AS vb FROM o)",
     """x AS (SELECT row_number() OVER (ORDER BY "Store", "Date") - 1 AS i, y, coalesce(lag_7, va) AS a,
        coalesce(rolling_mean_7, vb) AS b, count(*) OVER () AS total FROM o, med)""")
_MOMENTS = """count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb,
        corr(a, b) AS r, covar_pop(a, y) / stddev_pop(a) AS ra, covar_pop(b, y) / stddev_pop(b) AS rb"""


def _solved(name: str, source: str, alpha: float, keys: str = "") -> tuple[str, str]:
    """CTEs ``name``: intercept b0 and coefficients ca, cb of standardised ridge from moments of ``source``."""
    d = f"(1 + {alpha!r} / n)"
    det = f"({d} * {d} - r * r)"
    return (f"{name}_w AS (SELECT *, ({d} * ra - r * rb) / {det} / sa AS ca, ({d} * rb - r * ra) / {det} / sb AS cb FROM ({source}))",
            f"{name} AS (SELECT {keys}ca, cb, my - ca * ma - cb * mb AS b0 FROM {name}_w)")


def _two(spark, sf):
    o = B.drop_closed(_features(spark, sf), keep_flag=True)
    o = B.fill_with(o, B.train_medians(o, TWO), TWO)
    return o.select("Store", "Date", F.col("Sales").alias("y"), *TWO)


def _coef_sql(alpha: float) -> str:
    return with_panel(FEAT, *X, *_solved("fit", f"SELECT {_MOMENTS} FROM x", alpha)) + f"""
SELECT '(intercept)' AS feature, {srnd('b0', 4)} AS coef FROM fit UNION ALL SELECT 'lag_7', {srnd('ca', 8)} FROM fit
UNION ALL SELECT 'rolling_mean_7', {srnd('cb', 8)} FROM fit"""


def _coef_rows(spark, sf, spec):
    m = R.fit(_two(spark, sf), TWO, spec).model
    rows = [("(intercept)", m.raw_intercept, 4), *((f, c, 8) for f, c in zip(TWO, m.raw))]  # model parameters
    out = spark.createDataFrame(rows, "feature string, coef double, digits int")
    return out.select("feature", F.when(F.col("digits") == 4, rnd("coef", 4)).otherwise(rnd("coef", 8)).alias("coef"))


@query("ols_two", _coef_sql(0.0))
def q_ols_two(spark, sf):
    return _coef_rows(spark, sf, OLS)


@query("ridge_two", _coef_sql(RIDGE["alpha"]))
def q_ridge_two(spark, sf):
    return _coef_rows(spark, sf, RIDGE)


def _optimality(spark, sf, spec, l1_ratio):
    """Largest violation of the optimality conditions per input, relative to the penalty."""
    rows = segment_factors(_two(spark, sf), TWO, "y", F.lit(0))[0]
    x, y, sx = rows.standardised()
    w = rows.fit(spec)[1] * sx
    grad = x.T @ (y - x @ w) / rows.n - spec["alpha"] * (1 - l1_ratio) * w
    least = spec["alpha"] * l1_ratio
    gap = np.where(w != 0, np.abs(grad - least * np.sign(w)), np.maximum(np.abs(grad) - least, 0))
    scale = np.abs(x.T @ y / rows.n).max()
    return spark.createDataFrame([(f, float(g / scale)) for f, g in zip(TWO, gap)], "feature string, gap double").select(
        "feature", F.round("gap", 9).alias("gap"))


_ZERO = "SELECT 'lag_7' AS feature, CAST(0.0 AS DOUBLE) AS gap UNION ALL SELECT 'rolling_mean_7', 0.0"


@query("lasso_optimality", _ZERO)
def q_lasso_optimality(spark, sf):
    return _optimality(spark, sf, LASSO, 1.0)


@query("enet_optimality", _ZERO)
def q_enet_optimality(spark, sf):
    return _optimality(spark, sf, ENET, ENET["l1_ratio"])


def _fold_sql(alpha: float) -> str:
    return with_panel(FEAT, *X,
                      f"f AS (SELECT f, max(total) - ({FOLDS} - f) * (max(total) // {FOLDS + 1}) AS lo, max(total) // {FOLDS + 1} AS t FROM x, range({FOLDS}) g(f) GROUP BY f)",
                      *_solved("fit", f"SELECT f, lo, t, {_MOMENTS} FROM f JOIN x ON x.i < f.lo GROUP BY f, lo, t", alpha, "f, lo, t, ")) + f"""
SELECT CAST(f AS INTEGER) AS fold, {srnd('sqrt(avg(power(y - b0 - ca * a - cb * b, 2)))')} AS rmse
FROM fit JOIN x ON x.i >= lo AND x.i < lo + t GROUP BY f"""


def _fold_rows(spark, sf, spec):
    cv = R.ts_cv(_two(spark, sf), TWO, spec, FOLDS, entity="Store", order="Date")
    return spark.createDataFrame(list(enumerate(cv["cv_rmse_folds"])), "fold int, rmse double").select("fold", rnd("rmse").alias("rmse"))


@query("ts_cv_ols", _fold_sql(0.0))
def q_ts_cv_ols(spark, sf):
    return _fold_rows(spark, sf, OLS)


@query("ts_cv_ridge", _fold_sql(RIDGE["alpha"]))
def q_ts_cv_ridge(spark, sf):
    return _fold_rows(spark, sf, RIDGE)


def _curve_sql(alpha: float) -> str:
    part = "CAST(0.1 AS DOUBLE) + j * (CAST(1.0 AS DOUBLE) - CAST(0.1 AS DOUBLE)) / 9"
    err = "sqrt(avg(power(y - b0 - ca * a - cb * b, 2)))"
    return with_panel(FEAT, *X, f"""s AS (SELECT j, max(total) AS rows_n, greatest(CAST(floor(max(total) * ({part})) AS BIGINT), 100) AS e
                          FROM x, range({SIZES}) g(j) GROUP BY j)""",
                      f"f AS (SELECT j, f, rows_n, e, e // {CURVE_FOLDS + 1} AS t, e - ({CURVE_FOLDS} - f) * (e // {CURVE_FOLDS + 1}) AS lo FROM s, range({CURVE_FOLDS}) g(f))",
                      *_solved("fit", f"SELECT j, f, rows_n, e, lo, t, {_MOMENTS} FROM f JOIN x ON x.i < f.lo GROUP BY j, f, rows_n, e, lo, t", alpha, "j, f, rows_n, e, lo, t, "),
                      f"tr AS (SELECT j, f, rows_n, e, {err} AS v FROM fit JOIN x ON x.i < lo GROUP BY j, f, rows_n, e)",
                      f"va AS (SELECT j, f, {err} AS v FROM fit JOIN x ON x.i >= lo AND x.i < lo + t GROUP BY j, f)") + f"""
SELECT CAST(tr.j AS INTEGER) AS size_index, CAST(least(e, rows_n) AS INTEGER) AS n_rows, {srnd('avg(tr.v)')} AS train_rmse, {srnd('avg(va.v)')} AS val_rmse
FROM tr JOIN va ON tr.j = va.j AND tr.f = va.f GROUP BY tr.j, e, rows_n"""


def _curve_rows(spark, sf, spec):
    c = R.learning_curve(_two(spark, sf), TWO, spec, SIZES, CURVE_FOLDS, entity="Store", order="Date")
    return c.select("size_index", "n_rows", rnd("train_rmse").alias("train_rmse"), rnd("val_rmse").alias("val_rmse"))


@query("learning_curve_ols", _curve_sql(0.0))
def q_learning_curve_ols(spark, sf):
    return _curve_rows(spark, sf, OLS)


@query("learning_curve_ridge", _curve_sql(RIDGE["alpha"]))
def q_learning_curve_ridge(spark, sf):
    return _curve_rows(spark, sf, RIDGE)


# ---------------------------------------------------------------- boosted trees on two inputs
BOOSTED = {"kind": "gbt", "trees": 3, "depth": 2, "lr": 0.3, "subsample": 1.0, "colsample": 1.0, "min_child": 5, "l1": 0.1, "l2": 1.0}
BOOSTED_BINS = 16


def _boosted_ctes() -> list[str]:
    """Every level of every tree as an aggregate over (node, input, cut): ``t<k>`` has the predictions after k trees,
    ``s<k>_<d>`` the splits of a level."""
    probs = ", ".join(repr(i / BOOSTED_BINS) for i in range(1, BOOSTED_BINS))
    cut = "SELECT {} AS fi, unnest(list_distinct(quantile_cont({}, [{}]))) AS cut FROM x"
    score = lambda g, h: f"(greatest(abs({g}) - {BOOSTED['l1']!r}, 0) ** 2 / ({h} + {BOOSTED['l2']!r}))"
    ctes = [f"edges AS ({cut.format(0, 'a', probs)} UNION ALL {cut.format(1, 'b', probs)})",
            't0 AS (SELECT "Store", "Date", i, y, a, b, avg(y) OVER () AS p FROM x)']
    for k in range(BOOSTED["trees"]):
        ctes.append(f"n{k}_0 AS (SELECT *, p - y AS g, 0 AS node FROM t{k})")
        for d in range(BOOSTED["depth"]):
            ctes += [f"""c{k}_{d} AS (SELECT node, fi, cut, coalesce(sum(g) FILTER (WHERE v <= cut), 0) AS gl, count(*) FILTER (WHERE v <= cut) AS hl,
                           sum(g) AS gs, count(*) AS hs FROM (SELECT node, g, fi, cut, CASE fi WHEN 0 THEN a ELSE b END AS v FROM n{k}_{d}, edges) GROUP BY node, fi, cut)""",
                     f"""s{k}_{d} AS (SELECT * FROM (SELECT *, {score('gl', 'hl')} + {score('(gs - gl)', '(hs - hl)')} - {score('gs', 'hs')} AS gain FROM c{k}_{d}
                           WHERE hl >= {BOOSTED['min_child']} AND hs - hl >= {BOOSTED['min_child']}) WHERE gain > 1e-6
                           QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, fi, cut) = 1)""",
                     f"""n{k}_{d + 1} AS (SELECT n.* EXCLUDE (node), CASE WHEN s.cut IS NULL THEN n.node
                           ELSE 2 * n.node + 1 + CAST(CASE s.fi WHEN 0 THEN a ELSE b END > s.cut AS INTEGER) END AS node
                           FROM n{k}_{d} n LEFT JOIN s{k}_{d} s ON s.node = n.node)"""]
        leaf = f"-sign(sum(g)) * greatest(abs(sum(g)) - {BOOSTED['l1']!r}, 0) / (count(*) + {BOOSTED['l2']!r}) * {BOOSTED['lr']!r}"
        ctes += [f"l{k} AS (SELECT node, {leaf} AS value FROM n{k}_{BOOSTED['depth']} GROUP BY node)",
                 f't{k + 1} AS (SELECT "Store", "Date", i, y, a, b, p + value AS p FROM n{k}_{BOOSTED["depth"]} JOIN l{k} USING (node))']
    return ctes


_X_KEYS = (X[0], X[1], X[2].replace("- 1 AS i, y,", '- 1 AS i, "Store", "Date", y,'))
_BOOSTED_SQL = with_panel(FEAT, *_X_KEYS, *_boosted_ctes())


def _boosted(spark, sf):
    rows = cut_lineage(_two(spark, sf))
    return rows, boosting.fit_many(rows, TWO, "y", BOOSTED, [F.lit(True)], bins=BOOSTED_BINS)[0]


@query("gbt_two", _BOOSTED_SQL + f'SELECT "Store", "Date", {srnd("p", 4)} AS p FROM t{BOOSTED["trees"]}')
def q_gbt_two(spark, sf):
    rows, model = _boosted(spark, sf)
    return model.predict(rows, "p").select("Store", "Date", rnd("p", 4).alias("p"))


@query("staged_errors", _BOOSTED_SQL + " UNION ALL ".join(
    f"SELECT {k} AS trees, count(*) AS n, {srnd('sqrt(avg((y - p) ** 2))', 4)} AS rmse, {srnd('avg(abs(y - p))', 4)} AS mae FROM t{k}"
    for k in range(1, BOOSTED["trees"] + 1)))
def q_staged_errors(spark, sf):
    rows, model = _boosted(spark, sf)
    return boosting.staged_errors(rows, model, every=1).select("trees", "n", rnd("rmse", 4).alias("rmse"), rnd("mae", 4).alias("mae"))


_ALL_SPLITS = " UNION ALL ".join(f"SELECT fi, gain FROM s{k}_{d}" for k in range(BOOSTED["trees"]) for d in range(BOOSTED["depth"]))


@query("importance_two", _BOOSTED_SQL + f"""
SELECT feature, {srnd("coalesce(m, 0) / sum(m) OVER ()", 6)} AS importance FROM (VALUES (0, '{TWO[0]}'), (1, '{TWO[1]}')) f(fi, feature)
LEFT JOIN (SELECT fi, avg(gain) AS m FROM ({_ALL_SPLITS}) GROUP BY fi) USING (fi)""")
def q_importance_two(spark, sf):
    _, model = _boosted(spark, sf)
    return spark.createDataFrame(list(zip(TWO, model.importances())), "feature string, importance double").select(
        "feature", rnd("importance", 6).alias("importance"))


# ---------------------------------------------------------------- bootstrap on two inputs
BOOT = 5
_TWO_64 = 1 << 64


def _mixed_sql(x: str, rest: str, source: str) -> str:
    """``rest`` and ``h``, the 64-bit mixing of column expression ``x`` (unsigned), over ``source``."""
    times = lambda z, m: f"CAST((CAST({z} AS UHUGEINT) * {m}) % {_TWO_64} AS UBIGINT)"
    first = f"SELECT {rest}, {x} AS z FROM {source}"
    second = f"SELECT {rest}, {times('xor(z, z >> 30)', U.MIX_1)} AS z FROM ({first})"
    third = f"SELECT {rest}, {times('xor(z, z >> 27)', U.MIX_2)} AS z FROM ({second})"
    return f"SELECT {rest}, xor(z, z >> 31) AS h FROM ({third})"


def _bootstrap_sql() -> str:
    mixed = lambda x: int(U.mix64(np.array([x % _TWO_64], dtype=np.uint64))[0])
    streams = ", ".join(f"({r}, CAST({mixed((r + 1) * U.STEP + U.MIX_1)} AS UBIGINT))" for r in range(BOOT))
    key = """CAST("Store" * 100000 + date_diff('day', DATE '1970-01-01', "Date") AS UBIGINT)"""
    draw = f"CAST((CAST(stream AS UHUGEINT) + CAST(j AS UHUGEINT) * {U.GOLDEN}) % {_TWO_64} AS UBIGINT)"
    return with_panel(
        FEAT, *_X_KEYS, f"hashed AS ({_mixed_sql(key, 'y, a, b, total', 'x')})",
        "placed AS (SELECT y, a, b, row_number() OVER (ORDER BY h) - 1 AS place FROM hashed)",
        f"streams AS (SELECT * FROM (VALUES {streams}) t(rep, stream))",
        f"drawn AS ({_mixed_sql(draw, 'rep, total', '(SELECT rep, stream, total, unnest(range(1, total + 1)) AS j FROM streams, (SELECT any_value(total) AS total FROM x))')})",
        "picked AS (SELECT rep, CAST(floor(CAST(h >> 11 AS DOUBLE) / 9007199254740992.0 * total) AS BIGINT) AS place FROM drawn)",
        *_solved("fit", f"SELECT rep, {_MOMENTS} FROM picked JOIN placed USING (place) GROUP BY rep", RIDGE["alpha"], "rep, ")) + f"""
SELECT CAST(rep AS INTEGER) AS replica, {srnd('b0', 4)} AS intercept, {srnd('ca', 6)} AS lag_7, {srnd('cb', 6)} AS rolling_mean_7 FROM fit"""


@query("bootstrap_two", _bootstrap_sql())
def q_bootstrap_two(spark, sf):
    key = U.mixed_key(F.col("Store") * 100000 + F.unix_date("Date"))
    ens = U.bootstrap_fit(_two(spark, sf), TWO, BOOT, RIDGE, key=key)
    rows = [(r, b0, *c) for r, (b0, c) in enumerate(zip(ens.intercepts, ens.coefs))]  # model parameters
    return spark.createDataFrame(rows, "replica int, intercept double, lag_7 double, rolling_mean_7 double").select(
        "replica", rnd("intercept", 4).alias("intercept"), *[rnd(c, 6).alias(c) for c in TWO])


# ---------------------------------------------------------------- the fitted model in the monitor (M4, M6)
_MONITORED = with_panel(CUT, FEAT, *_X_KEYS,
                        *_solved("fit", f"""SELECT {_MOMENTS} FROM x WHERE "Date" <= (SELECT c FROM cut)""", RIDGE["alpha"]),
                        """e AS (SELECT "Store", "Date", y - (b0 + ca * a + cb * b) AS residual FROM x, fit WHERE "Date" > (SELECT c FROM cut))""",
                        """b AS (SELECT CAST("Store" AS VARCHAR) AS entity, CAST(date_trunc('month', "Date") AS DATE) AS batch,
                           avg(residual) AS m, stddev_pop(residual) AS s, count(*) AS n FROM e GROUP BY 1, 2)""")


@query("monitor_model", _cusum_sql(_MONITORED.replace("WITH ", "WITH RECURSIVE ", 1).rstrip(), 0.5) + f"""
SELECT entity, batch, {srnd('m', 4)} AS mean_residual, {srnd('s', 4)} AS std_residual, n AS n_samples,
       {srnd('pos', 3)} AS cusum_pos, {srnd('neg', 3)} AS cusum_neg, alert FROM r""")
def q_monitor_model(spark, sf):
    """A model fitted on the training days, its test residuals in monthly batches per store, CUSUM over them."""
    train, test = V.time_split(cut_lineage(_two(spark, sf)), 3)
    scored = R.fit(train, TWO, RIDGE).predict(test, "p").withColumn("Store", F.col("Store").cast("string"))
    c = M.cusum(M.residual_batches(scored, "Store", F.trunc("Date", "month"), F.col("y") - F.col("p")), threshold=MONITOR_LIMIT, k_factor=0.5)
    return c.select("entity", "batch", rnd("mean_residual", 4).alias("mean_residual"), rnd("std_residual", 4).alias("std_residual"), "n_samples",
                    rnd("cusum_pos", 3).alias("cusum_pos"), rnd("cusum_neg", 3).alias("cusum_neg"), "alert")


# ---------------------------------------------------------------- balanced random folds
def _folds_sql() -> str:
    key = """CAST("Store" * 100000 + date_diff('day', DATE '1970-01-01', "Date") AS UBIGINT)"""
    signed = f"CASE WHEN h >= {1 << 63} THEN CAST(CAST(h AS HUGEINT) - {_TWO_64} AS BIGINT) ELSE CAST(h AS BIGINT) END"
    hashed = _mixed_sql(key, '"Store", "Date", "StoreType", "Sales"', 'panel WHERE "Open" = 1')
    return with_panel(f"hashed AS ({hashed})",
                      f"""folds AS (SELECT "Store", "Date", "StoreType", "Sales",
                          CAST((row_number() OVER (ORDER BY {signed}) - 1) % 5 AS INTEGER) AS fold FROM hashed)""",
                      """st AS (SELECT "StoreType", fold, sum("Sales") AS s, count("Sales") AS n FROM folds GROUP BY ALL)""",
                      """other AS (SELECT "StoreType", fold, (sum(s) OVER t - s) / nullif(sum(n) OVER t - n, 0) AS enc FROM st
                          WINDOW t AS (PARTITION BY "StoreType"))""") + f"""
SELECT "Store", "Date", fold, {srnd('coalesce(enc, (SELECT avg("Sales") FROM folds))', 4)} AS "StoreType_target_enc"
FROM folds LEFT JOIN other USING ("StoreType", fold)"""


@query("oof_balanced", _folds_sql())
def q_oof_balanced(spark, sf):
    """Out-of-fold target means over folds of equal size."""
    o = B.drop_closed(store_panel(spark, sf, materialize=True), keep_flag=True)
    key = U.mixed_key(F.col("Store") * 100000 + F.unix_date("Date"))
    o = V.balanced_folds(o, ["Store", "Date"], 5, key=key)
    enc = E.target_encode_oof(o, ["StoreType"], "Sales", fold=F.col("fold"))
    return enc.select("Store", "Date", "fold", rnd("StoreType_target_enc", 4).alias("StoreType_target_enc"))
