"""Regression at scale.

Linear models (least squares, ridge, lasso, elastic net; features standardised
with mean and population std of the training rows) are solved from triangular
factors of the rows (``operators.factors``): one pass, no collected rows, the
accuracy of working on the rows. One solver serves single fits, folds, learning
curves and the model comparison. Boosted trees grow on histograms
(``operators.boosting``), all folds of a run at once; a spec that names the engine
``xgboost`` takes that package's Spark estimator.
"""

from __future__ import annotations

import math
import statistics
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators import boosting, encoders as E
from tillcast.operators import splits as V
from tillcast.operators import stats as G
from tillcast.operators.factors import segment_factors, stack

# The compared model set and its hyper-parameters.
MODEL_SPECS = {
    "LinearRegression": {"kind": "ols"},
    "Ridge (L2)": {"kind": "ridge", "alpha": 10.0},
    "Lasso (L1)": {"kind": "lasso", "alpha": 1.0, "max_iter": 5000},
    "ElasticNet": {"kind": "enet", "alpha": 1.0, "l1_ratio": 0.5, "max_iter": 5000},
    "XGBoost": {"kind": "gbt", "trees": 500, "depth": 6, "lr": 0.05, "subsample": 0.8, "colsample": 0.8,
                "min_child": 5, "l1": 0.1, "l2": 1.0},
}
# The 200-tree boosted model used as the accurate tier of the router.
ACCURATE_SPEC = {"kind": "gbt", "trees": 200, "depth": 6, "lr": 0.05, "subsample": 1.0, "colsample": 1.0,
                 "min_child": 1}


LINEAR_KINDS = ("ols", "ridge", "lasso", "enet")


@dataclass
class Linear:
    """A linear model: intercept and coefficients of the standardised features
    (what importances compare), and of the features as they are."""
    intercept: float
    coefficients: list[float]
    raw_intercept: float
    raw: list[float]


@dataclass
class Fitted:
    kind: str
    features: list[str]
    scaler: E.Scaler | None
    model: object
    label: str = "y"

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        if self.kind == "xgboost":
            return self.model.setPredictionCol(out).transform(df)
        if self.kind in LINEAR_KINDS:  # a projection: no vector is built
            p = F.lit(self.model.raw_intercept)
            for f, c in zip(self.features, self.model.raw):
                p = p + F.lit(c) * F.col(f)
            return df.withColumn(out, p)
        return self.model.predict(df, out)

    def importances(self) -> list[float]:
        if self.kind == "xgboost":
            score = self.model.get_booster().get_score(importance_type="gain")
            return [float(score.get(f, score.get(f"f{i}", 0.0))) for i, f in enumerate(self.features)]
        if self.kind == "gbt":
            return self.model.importances()
        return [abs(v) for v in self.model.coefficients]


def fit(train: DataFrame, features, spec: dict, label: str = "y", seed: int = 42) -> Fitted:
    """Fit one model described by ``spec`` (see MODEL_SPECS)."""
    features = list(features)
    kind = spec["kind"]
    if kind == "gbt" and _own_engine(spec):
        return Fitted(kind, features, None, boosting.fit_many(train, features, label, spec, [F.lit(True)], seed)[0], label)
    if kind == "gbt":
        return _xgboost_fit(train, features, spec, label, seed)
    if kind not in LINEAR_KINDS:
        raise ValueError(kind)
    rows = segment_factors(train, features, label, F.lit(0))[0]
    b0, coef = rows.fit(spec)
    return Fitted(kind, features, None, Linear(float(rows.means()[-1]), (coef * rows.scales()).tolist(), b0, coef.tolist()), label)


def _own_engine(spec: dict) -> bool:
    return spec.get("engine", "histogram") != "xgboost"


def _xgboost_fit(train: DataFrame, features, spec: dict, label: str, seed: int) -> Fitted:
    """The boosted-tree model of the optional ``xgboost`` Spark estimator, for specs
    that name that engine; an error where it is not installed."""
    from xgboost.spark import SparkXGBRegressor

    est = SparkXGBRegressor(features_col=list(features), label_col=label, n_estimators=spec["trees"],
                            max_depth=spec["depth"], learning_rate=spec["lr"], subsample=spec["subsample"],
                            colsample_bytree=spec["colsample"], min_child_weight=spec["min_child"],
                            reg_alpha=spec.get("l1", 0.0), reg_lambda=spec.get("l2", 1.0), random_state=seed)
    return Fitted("xgboost", list(features), None, est.fit(train), label)


def rmse(pred: DataFrame, label: str = "y", p: str = "p") -> float:
    return float(pred.agg(F.sqrt(F.avg((F.col(label) - F.col(p)) ** 2))).first()[0])


# ---------------------------------------------------------------- one-pass folds for linear models

def fold_factors(idx: DataFrame, n: int, k: int, features, label: str, idx_col: str = "__idx") -> dict:
    """Factors per expanding-fold segment: segment 0 = rows before the first
    test block, segment f+1 = test block of fold f."""
    first, t = V.fold_bounds(n, k)[0][1], n // (k + 1)
    i = F.col(idx_col)
    seg = F.when(i < first, F.lit(0)).otherwise(F.least(F.floor((i - first) / t) + 1, F.lit(k)))
    return segment_factors(idx, features, label, seg)


def _cv_from_factors(spec: dict, found: dict, k: int) -> dict:
    scores = []
    for f in range(k):
        b0, coef = stack([found[s] for s in range(f + 1) if s in found]).fit(spec)
        te = found[f + 1]
        scores.append(math.sqrt(te.sse(b0, coef) / te.n))
    return {"cv_rmse_folds": scores, "cv_rmse_mean": statistics.fmean(scores), "cv_rmse_std": statistics.pstdev(scores)}


def ts_cv(train: DataFrame, features, spec: dict, k: int = 5, entity: str = "key_store", order: str = "key_date",
          label: str = "y") -> dict:
    """Expanding-window CV by row order (entity, order); per-fold RMSE,
    their mean and population std. Each fold refits the scaler.

    Linear models use one pass: rows are labelled with their fold segment,
    every segment is reduced to its triangular factor, and every fold's fit
    and test error come from those. Boosted models of all folds grow in one
    run. Other models refit per fold.
    """
    idx = V.row_index(train, entity, order, "__idx")
    n = train.count()
    if spec["kind"] in LINEAR_KINDS:
        return _cv_from_factors(spec, fold_factors(idx, n, k, features, label), k)
    if spec["kind"] == "gbt" and _own_engine(spec):
        return _boosted_folds(idx, n, features, spec, k, label)[1]
    scores = []
    for fold, lo, hi in V.fold_bounds(n, k):
        tr = idx.where(F.col("__idx") < lo)
        te = idx.where((F.col("__idx") >= lo) & (F.col("__idx") < hi))
        m = fit(tr, features, spec, label)
        scores.append(rmse(m.predict(te), label))
    return {"cv_rmse_folds": scores, "cv_rmse_mean": statistics.fmean(scores),
            "cv_rmse_std": statistics.pstdev(scores)}


def _in(lo, hi=None) -> Column:
    return (F.col("__idx") < lo) if hi is None else (F.col("__idx") >= lo) & (F.col("__idx") < hi)


def _sides(*sides: tuple[int, str, Column]) -> Column:
    """Array of (model, side) for the rows that each condition holds for."""
    return F.array_compact(F.array(*[F.when(c, F.struct(F.lit(m).alias("model"), F.lit(side).alias("side"))) for m, side, c in sides]))


def _boosted_folds(idx: DataFrame, n: int, features, spec: dict, k: int, label: str) -> tuple[Fitted, dict]:
    """The model of all rows and the fold errors, from one run of ``k`` + 1 fits."""
    features, bounds = list(features), V.fold_bounds(n, k)
    rows = idx.select("__idx", *features, label)
    models = boosting.fit_many(rows, features, label, spec, [_in(lo) for _, lo, _ in bounds] + [F.lit(True)])
    found = boosting.errors_by(rows, models, label, _sides(*[(f, "test", _in(lo, hi)) for f, lo, hi in bounds])) if k else {}
    scores = [boosting.rmse_of(found[f, "test"]) for f in range(k)]
    return Fitted("gbt", features, None, models[-1], label), boosting.spread(scores) if k else {}


COMPARE_SCHEMA = T.StructType([T.StructField(c, t) for c, t in [
    ("model", T.StringType()), ("train_R2", T.DoubleType()), ("test_R2", T.DoubleType()),
    ("test_RMSE", T.DoubleType()), ("test_MAE", T.DoubleType()), ("test_RMSPE", T.DoubleType()),
    ("test_MAPE", T.DoubleType()), ("cv_RMSE_mean", T.DoubleType()), ("cv_RMSE_std", T.DoubleType()),
    ("overfit_gap", T.DoubleType())]])


def model_compare(train: DataFrame, test: DataFrame, features, specs: dict | None = None, cv_folds: int = 5,
                  label: str = "y") -> DataFrame:
    """CV, full fit and train/test metrics per model, sorted by test RMSPE.

    Linear models (OLS, ridge, lasso, elastic net) are all solved from one
    pass of per-fold-segment triangular factors (least squares or coordinate
    descent on the Gram matrix); a boosted model grows with those of its folds. Predictions of
    all models are stacked into one long (model, split, y, p) table and
    scored by a single grouped metrics aggregate.
    """
    specs = specs or MODEL_SPECS
    cv, preds = {}, []
    features = list(features)
    linear = {nm: sp for nm, sp in specs.items() if sp["kind"] in LINEAR_KINDS}
    if linear:
        # every linear model, every fold and the full-train fit from ONE pass of segment factors
        idx = V.row_index(train, "key_store", "key_date", "__idx")
        n = train.count()
        found = fold_factors(idx, n, cv_folds or 1, features, label)
        total = stack(found.values())
        for name, spec in linear.items():
            cv[name] = _cv_from_factors(spec, found, cv_folds) if cv_folds else None
            b0, coef = total.fit(spec)
            p_expr = F.lit(float(b0))
            for f, c in zip(features, coef):
                p_expr = p_expr + F.lit(float(c)) * F.col(f)
            for split, df in (("train", train), ("test", test)):
                preds.append(df.select(F.lit(name).alias("model"), F.lit(split).alias("split"),
                                       F.col(label).alias("y"), p_expr.alias("p")))
    for name, spec in specs.items():
        if name in linear:
            continue
        if spec["kind"] == "gbt" and _own_engine(spec):
            m, cv[name] = _boosted_folds(V.row_index(train, "key_store", "key_date", "__idx"), train.count(), features, spec, cv_folds or 0, label)
        else:
            cv[name] = ts_cv(train, features, spec, cv_folds, label=label) if cv_folds else None
            m = fit(train, features, spec, label)
        for split, df in (("train", train), ("test", test)):
            preds.append(m.predict(df.select(*features, label)).select(
                F.lit(name).alias("model"), F.lit(split).alias("split"), F.col(label).alias("y"), F.col("p")))
    long = preds[0]
    for p in preds[1:]:
        long = long.unionByName(p)
    met = {(r["model"], r["split"]): r for r in G.regression_metrics(long, by=["model", "split"]).collect()}
    rows = []
    for name in specs:
        tr, te = met[(name, "train")], met[(name, "test")]
        c = cv[name] or {}
        rows.append((name, tr["R2"], te["R2"], te["RMSE"], te["MAE"], te["RMSPE"], te["MAPE"],
                     c.get("cv_rmse_mean"), c.get("cv_rmse_std"), tr["R2"] - te["R2"]))
    out = train.sparkSession.createDataFrame(rows, COMPARE_SCHEMA)  # one row per model
    return out.orderBy("test_RMSPE")


def importance_table(model: Fitted, top_n: int = 20) -> DataFrame:
    """Top-N importances (tree importances or |coef|), flagged above the median of all.

    The importances are model parameters (one value per feature), so this
    table is built from the fitted model, not from data rows.
    """
    from pyspark.sql import SparkSession
    vals = model.importances()
    med = statistics.median(vals) if vals else 0.0
    ranked = sorted(zip(model.features, vals), key=lambda t: -t[1])[:top_n]
    rows = [(f, v, v > med, i + 1) for i, (f, v) in enumerate(ranked)]
    return SparkSession.getActiveSession().createDataFrame(
        rows, "feature string, importance double, above_median boolean, rank int")


def residual_table(pred: DataFrame, label: str = "y", p: str = "p", keys=()) -> DataFrame:
    """(keys,) fitted, residual, actual."""
    return pred.select(*keys, F.col(p).alias("fitted"), (F.col(label) - F.col(p)).alias("residual"),
                       F.col(label).alias("actual"))


def qq_grid(residuals: DataFrame, col: str = "residual", points: int = 199) -> DataFrame:
    """Q-Q points on a fixed probability grid plus the fitted line.

    Sample quantiles come from the exact distributed ranks at ``points``
    plotting positions (no global sort of the residuals); theoretical
    quantiles from a JVM-side normal quantile expression over that grid.
    Returns (prob, theoretical, sample, slope, intercept, r).
    """
    probs = [(i + 0.5) / points for i in range(points)]
    from tillcast.operators.ranks import column_quantiles
    q = column_quantiles(residuals, [col], probs)  # exact, distributed ranks
    from tillcast.functions.scalars import normal_quantile
    grid = (q.select(F.col("pi").alias("i"), F.col("q").alias("sample"))
            .withColumn("prob", (F.lit(0.5) + F.col("i")) / F.lit(points))
            .withColumn("theoretical", normal_quantile(F.col("prob"))))
    fit = grid.agg(F.regr_slope("sample", "theoretical").alias("slope"),
                   F.regr_intercept("sample", "theoretical").alias("intercept"),
                   F.corr("sample", "theoretical").alias("r")).first()  # three numbers over <= points rows
    return grid.select("prob", "theoretical", "sample", *[F.lit(fit[k]).cast("double").alias(k)
                                                          for k in ("slope", "intercept", "r")])


def learning_curve(train: DataFrame, features, spec: dict, sizes: int = 10, folds: int = 3,
                   entity: str = "key_store", order: str = "key_date", label: str = "y") -> DataFrame:
    """V4: for 10 prefix sizes max(int(n * s), 100), s in linspace(0.1, 1, 10),
    expanding 3-fold CV on the prefix (folds with < 10 train or < 5 test rows
    skipped); mean train and validation RMSE per size."""
    idx = V.row_index(train, entity, order, "__idx")
    n = train.count()
    if spec["kind"] in LINEAR_KINDS:
        return _learning_curve_linear(train, idx, n, features, spec, sizes, folds, label)
    if spec["kind"] == "gbt" and _own_engine(spec):
        return _learning_curve_boosted(train, idx, n, features, spec, sizes, folds, label)
    rows = []
    for j in range(sizes):
        s = 0.1 + j * (1.0 - 0.1) / (sizes - 1)
        end = max(int(n * s), 100)
        tr_scores, va_scores = [], []
        for _, lo, hi in V.fold_bounds(end, folds):
            if lo < 10 or hi - lo < 5:
                continue
            tr = idx.where(F.col("__idx") < lo)
            va = idx.where((F.col("__idx") >= lo) & (F.col("__idx") < hi))
            m = fit(tr, features, spec, label)
            tr_scores.append(rmse(m.predict(tr), label))
            va_scores.append(rmse(m.predict(va), label))
        if tr_scores:
            rows.append((j, min(end, n), statistics.fmean(tr_scores), statistics.fmean(va_scores)))
    return train.sparkSession.createDataFrame(rows, "size_index int, n_rows int, train_rmse double, val_rmse double")


def _learning_curve_plan(n: int, sizes: int, folds: int):
    plan = []
    for j in range(sizes):
        s = 0.1 + j * (1.0 - 0.1) / (sizes - 1)
        end = max(int(n * s), 100)
        fl = [(lo, hi) for _, lo, hi in V.fold_bounds(end, folds) if lo >= 10 and hi - lo >= 5]
        plan.append((j, end, fl))
    return plan


def _learning_curve_boosted(train, idx, n, features, spec, sizes, folds, label):
    """V4 for boosted trees: the models of all sizes and folds grow in one run, and one pass gives all errors."""
    cuts = [(j, end, lo, hi) for j, end, fl in _learning_curve_plan(n, sizes, folds) for lo, hi in fl]
    idx = idx.select("__idx", *features, label)
    models = boosting.fit_many(idx, features, label, spec, [_in(lo) for _, _, lo, _ in cuts])
    found = boosting.errors_by(idx, models, label, _sides(*[(m, side, c) for m, (_, _, lo, hi) in enumerate(cuts)
                                                            for side, c in (("train", _in(lo)), ("val", _in(lo, hi)))]))
    rows = []
    for j in sorted({c[0] for c in cuts}):
        mine = [m for m, c in enumerate(cuts) if c[0] == j]
        rows.append((j, min(cuts[mine[0]][1], n), *(statistics.fmean(boosting.rmse_of(found[m, side]) for m in mine) for side in ("train", "val"))))
    return train.sparkSession.createDataFrame(rows, "size_index int, n_rows int, train_rmse double, val_rmse double")


def _learning_curve_linear(train, idx, n, features, spec, sizes, folds, label):
    """V4 for linear models in one pass: the prefix sizes and fold bounds cut the
    row order into segments, each reduced to its triangular factor."""
    import bisect
    plan = _learning_curve_plan(n, sizes, folds)
    cuts = sorted({c for _, _, fl in plan for lo, hi in fl for c in (lo, hi)} | {0})
    i = F.col("__idx")
    seg = F.lit(len(cuts) - 1)
    for k in range(len(cuts) - 1, 0, -1):
        seg = F.when(i < F.lit(cuts[k]), F.lit(k - 1)).otherwise(seg)
    found = segment_factors(idx, features, label, seg)

    def rng(lo, hi):
        a, b = bisect.bisect_left(cuts, lo), bisect.bisect_left(cuts, hi)
        return stack([found[s] for s in range(a, b) if s in found])

    rows = []
    for j, end, fl in plan:
        tr_s, va_s = [], []
        for lo, hi in fl:
            tr, va = rng(0, lo), rng(lo, hi)
            b0, coef = tr.fit(spec)
            tr_s.append(math.sqrt(tr.sse(b0, coef) / tr.n))
            va_s.append(math.sqrt(va.sse(b0, coef) / va.n))
        if tr_s:
            rows.append((j, min(end, n), statistics.fmean(tr_s), statistics.fmean(va_s)))
    return train.sparkSession.createDataFrame(rows, "size_index int, n_rows int, train_rmse double, val_rmse double")
