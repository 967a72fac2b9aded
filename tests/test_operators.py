"""Layer 2/3: hand-computed fixtures for the semantic traps and properties.

Inputs here are tiny hand-made frames (the operators are generic); the
expected values come from brute-force numpy on the same inputs.
"""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions import scalars as S
from tillcast.operators import drift as M
from tillcast.operators import encoders as E
from tillcast.operators import filters as B
from tillcast.operators import profile as P
from tillcast.operators import ranks as K
from tillcast.operators import stats as G
from tillcast.operators import uncertainty as U
from tillcast.operators import windows as W

D0 = dt.date(2024, 1, 1)


def _series(spark, values, store=1, start=D0):
    rows = [(store, start + dt.timedelta(days=i), float(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "Store int, Date date, Sales double")


def _numpy_slope(y):
    return float(np.polyfit(np.arange(len(y)), y, 1)[0])


# ---------------------------------------------------------------- windows
def test_slope_warmup_and_values(spark):
    y = [i ** 1.5 for i in range(40)]
    out = W.trend_slope(_series(spark, y)).orderBy("Date").collect()
    got = [r["trend_slope_30d"] for r in out]
    assert all(v == 0.0 for v in got[:30])
    for i in range(30, 40):
        assert got[i] == pytest.approx(_numpy_slope(y[i - 30:i]), rel=1e-9)


def test_rolling_partial_and_std_rules(spark):
    y = [1.0, 2.0, 4.0, 8.0]
    out = W.rolling_std(W.rolling_mean(_series(spark, y), windows=(7,)), windows=(7,)).orderBy("Date").collect()
    assert out[0]["rolling_mean_7"] is None and out[0]["rolling_std_7"] == 0.0
    assert out[1]["rolling_mean_7"] == 1.0 and out[1]["rolling_std_7"] == 0.0   # n=1 -> 0
    assert out[3]["rolling_mean_7"] == pytest.approx(7 / 3)
    assert out[3]["rolling_std_7"] == pytest.approx(np.std([1, 2, 4], ddof=1))


def test_lags_count_rows_not_days(spark):
    rows = [(1, D0, 1.0), (1, D0 + dt.timedelta(days=5), 2.0), (1, D0 + dt.timedelta(days=7), 3.0)]
    df = spark.createDataFrame(rows, "Store int, Date date, Sales double")
    by_row = W.lag_features(df, lags=(1,)).orderBy("Date").collect()
    assert [r["lag_1"] for r in by_row] == [None, 1.0, 2.0]
    by_day = W.lag_features(df, lags=(7,), calendar=True).orderBy("Date").collect()
    assert [r["lag_7"] for r in by_day] == [None, None, 1.0]


def test_no_leakage_from_future(spark):
    y = list(np.random.default_rng(1).normal(100, 10, 60))
    base = W.panel_features(_series(spark, y).withColumns({"Promo": F.lit(1), "SchoolHoliday": F.lit(0)}))
    y2 = y[:45] + [v * 3 for v in y[45:]]
    alt = W.panel_features(_series(spark, y2).withColumns({"Promo": F.lit(1), "SchoolHoliday": F.lit(0)}))
    cols = ["lag_7", "rolling_mean_7", "rolling_std_30", "trend_slope_30d"]
    a = base.orderBy("Date").select(*cols).collect()[:46]
    b = alt.orderBy("Date").select(*cols).collect()[:46]
    assert a == b


def test_panel_features_single_exchange(spark):
    df = _series(spark, range(50)).withColumns({"Promo": F.lit(0), "SchoolHoliday": F.lit(0)})
    plan = W.panel_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_partition_count_independent(spark):
    df = spark.createDataFrame([(s, D0 + dt.timedelta(days=i), float((i * 7 + s) % 13)) for s in range(4)
                                for i in range(40)], "Store int, Date date, Sales double")
    feats = W.panel_features(df.withColumns({"Promo": F.lit(1), "SchoolHoliday": F.lit(1)}))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(feats.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == sorted(feats.collect())


# ---------------------------------------------------------------- scalar traps
def test_holiday_null_and_iso_week(spark):
    df = spark.createDataFrame([("0",), ("a",), (None,)], "h string")
    assert [r[0] for r in df.select(S.holiday_binary("h")).collect()] == [0, 1, 1]
    r = spark.range(1).select(S.iso_week(F.lit(dt.date(2021, 1, 3))), S.is_weekend(F.lit(dt.date(2021, 1, 3))),
                              S.months_before(F.lit(dt.date(2023, 5, 31)), 3)).first()
    assert (r[0], r[1], r[2]) == (53, 1, dt.date(2023, 2, 28))


# ---------------------------------------------------------------- ranks
def test_exact_quantiles_match_numpy_with_slices(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.gamma(2.0, 10.0, 3000), 1)  # many duplicates
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["pi"]): r["q"] for r in K.exact_quantiles(df, "g", "v", probs, buckets=8).collect()}
    for g in ("a", "b"):
        x = np.array([v for k, v in rows if k == g])
        for i, p in enumerate(probs):
            assert got[(g, i)] == pytest.approx(float(np.percentile(x, p * 100)), rel=1e-12)


def test_cumulative_counts_bruteforce(spark):
    rows = [("f", float(v), 1 + (v % 3)) for v in range(200)]
    df = spark.createDataFrame(rows, "g string, v double, c int")
    out = {r["v"]: r["cum_c"] for r in K.cumulative_counts(df, "g", "v", ["c"], buckets=5).collect()}
    run = 0
    for _, v, c in rows:
        run += c
        assert out[v] == run


# ---------------------------------------------------------------- PSI
def _np_psi(ref, cur, n_bins=10, eps=1e-6):
    bp = np.unique(np.nanpercentile(ref, np.linspace(0, 100, n_bins + 1)))
    r = np.histogram(ref, bins=bp)[0] + eps
    c = np.histogram(cur, bins=bp)[0] + eps
    r, c = r / r.sum(), c / c.sum()
    return float(np.sum((c - r) * np.log(c / r)))


def _psi(spark, ref, cur, **kw):
    a = spark.createDataFrame([(float(v),) for v in ref], "x double")
    b = spark.createDataFrame([(float(v),) for v in cur], "x double")
    rows = M.psi_report(a, b, ["x"], **kw).collect()
    return rows[0]["PSI"] if rows else None


def test_psi_binary_single_bin(spark):
    assert _psi(spark, [0] * 55 + [1] * 45, [1] * 100) == 0.0


def test_psi_binary_interpolated_breakpoint(spark):
    ref, cur = [0] * 60 + [1] * 40, [1] * 100
    assert _psi(spark, ref, cur) == pytest.approx(_np_psi(np.array(ref, float), np.array(cur, float)), rel=1e-9)
    assert _psi(spark, ref, cur) == pytest.approx(11.2957, abs=1e-3)


def test_psi_constant_and_out_of_range(spark):
    assert _psi(spark, [5] * 50, list(range(50))) == 0.0
    ref, cur = list(range(100)), list(range(1000, 1100))
    assert _psi(spark, ref, cur) == pytest.approx(_np_psi(np.array(ref, float), np.array(cur, float)), abs=1e-12)
    assert _psi(spark, ref, cur, open_ended=True) > 1.0


def test_psi_continuous_matches_numpy(spark):
    rng = np.random.default_rng(3)
    ref, cur = rng.normal(0, 1, 500), rng.normal(0.3, 1.2, 400)
    assert _psi(spark, ref, cur) == pytest.approx(_np_psi(ref, cur), rel=1e-9)


def test_psi_size_guard(spark):
    assert _psi(spark, list(range(9)), list(range(50))) is None


# ---------------------------------------------------------------- KS
def test_ks_statistic_bruteforce(spark):
    rng = np.random.default_rng(5)
    a, b = np.round(rng.normal(0, 1, 300), 2), np.round(rng.normal(0.2, 1, 250), 2)
    grid = np.unique(np.concatenate([a, b]))
    d = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    ra = spark.createDataFrame([(float(v),) for v in a], "x double")
    rb = spark.createDataFrame([(float(v),) for v in b], "x double")
    r = M.ks_report(ra, rb, ["x"], buckets=4).first()
    assert r["KS_stat"] == pytest.approx(d, abs=1e-12)
    lam = math.sqrt(300 * 250 / 550) * d
    q = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    assert r["p_value"] == pytest.approx(min(1.0, max(0.0, q)), abs=1e-12)


# ---------------------------------------------------------------- CUSUM
def test_cusum_reset_only_fired_side(spark):
    b = spark.createDataFrame([("e", 1, 4.0, 1.0, 10), ("e", 2, 3.0, 1.0, 10), ("e", 3, 9.0, 1.0, 10)],
                              "entity string, batch int, mean_residual double, std_residual double, n_samples long")
    out = M.cusum(b, threshold=5.0, k_factor=0.5).orderBy("batch").collect()
    assert [r["alert"] for r in out] == [None, "POSITIVE_DRIFT", "POSITIVE_DRIFT"]
    assert out[0]["cusum_pos"] == 3.5 and out[1]["alert_value"] == 6.0 and out[1]["cusum_pos"] == 0.0
    assert out[2]["alert_value"] == 8.5


def test_stream_equals_batch(spark, tmp_path):
    from tillcast.streaming.cusum_stream import cusum_stream, event_stream, run_to_table
    rows = [("e", dt.datetime(2024, 1, d, 12), v) for d, v in ((1, 3.0), (2, 4.0), (3, 9.0), (9, 1.0))]
    src = spark.createDataFrame(rows, "event_type string, ts timestamp, value double")
    src.coalesce(1).write.parquet(str(tmp_path / "ev"))
    ev = event_stream(spark, str(tmp_path / "ev"), src.schema)
    out = run_to_table(spark, cusum_stream(ev, "event_type", "ts", F.col("value"), threshold=1e9, k_factor=0.0))
    got = [r["cusum_pos"] for r in out.orderBy("batch").collect()]
    assert got == [3.0, 7.0, 16.0]  # 9 January stays open until a later event


def test_stream_goes_on_where_the_batch_ended(spark, tmp_path):
    """Batch up to day 15, then a stream from day 16 (or a second batch): the same rows as the whole batch."""
    from tillcast.streaming.cusum_stream import cusum_stream, event_stream, run_to_table
    rng = np.random.default_rng(8)
    rows = [(e, dt.datetime(2024, 1, d, h), float(v)) for e in ("a", "b") for d in range(1, 31) for h, v in zip((3, 12, 21), rng.normal(0.4, 2, 3))]
    rows += [("new", dt.datetime(2024, 1, d, 5), 1.0) for d in range(20, 31)]
    src = spark.createDataFrame(rows, "event_type string, ts timestamp, value double")
    batches = M.residual_batches(src, "event_type", F.to_date("ts"), F.col("value"))
    whole = {(r["entity"], r["batch"]): (r["cusum_pos"], r["cusum_neg"], r["alert"]) for r in M.cusum(batches, 4.0, 0.5).collect()}
    assert any(v[2] for v in whole.values())
    cut = dt.date(2024, 1, 15)
    start = M.last_states(M.cusum(batches.where(F.col("batch") <= cut), 4.0, 0.5))
    src.where(F.to_date("ts") > cut).coalesce(1).write.parquet(str(tmp_path / "late"))
    late = event_stream(spark, str(tmp_path / "late"), src.schema)
    stream = run_to_table(spark, cusum_stream(late, "event_type", "ts", F.col("value"), threshold=4.0, k_factor=0.5, initial=start))
    second = M.cusum(batches.where(F.col("batch") > cut), 4.0, 0.5, initial=start)
    for found, last in ((stream, 29), (second, 30)):
        got = {(r["entity"], r["batch"]): (r["cusum_pos"], r["cusum_neg"], r["alert"]) for r in found.collect()}
        want = {k: v for k, v in whole.items() if cut < k[1] <= dt.date(2024, 1, last)}
        assert set(got) == set(want)
        for k, v in want.items():
            assert got[k][:2] == pytest.approx(v[:2], abs=1e-9) and got[k][2] == v[2]


# ---------------------------------------------------------------- VIF
def test_vif_matches_regression_definition(spark):
    rng = np.random.default_rng(11)
    x1 = rng.normal(size=300)
    x2 = x1 * 0.8 + rng.normal(scale=0.5, size=300)
    x3 = rng.normal(size=300)
    X = np.column_stack([x1, x2, x3])
    df = spark.createDataFrame([tuple(map(float, r)) for r in X], "a double, b double, c double")
    got = dict(zip(["a", "b", "c"], G.vif_values(df, ["a", "b", "c"])))
    for j, name in enumerate("abc"):
        others = np.column_stack([np.ones(300), np.delete(X, j, axis=1)])
        beta, *_ = np.linalg.lstsq(others, X[:, j], rcond=None)
        resid = X[:, j] - others @ beta
        r2 = 1 - resid @ resid / ((X[:, j] - X[:, j].mean()) @ (X[:, j] - X[:, j].mean()))
        assert got[name] == pytest.approx(1 / (1 - r2), rel=1e-9)
    unc = G.vif_values(df, ["a", "b", "c"], intercept=False)
    m = X.T @ X
    assert unc[0] == pytest.approx(m[0, 0] * np.linalg.inv(m)[0, 0], rel=1e-9)


# ---------------------------------------------------------------- encoders
def test_group_median_and_target_encoding(spark):
    tr = spark.createDataFrame([("a", 1.0, 10.0), ("a", 3.0, 20.0), ("b", None, 30.0), ("c", 7.0, 40.0)],
                               "g string, x double, y double")
    imp = E.fit_group_median(tr, "x", "g")
    te = spark.createDataFrame([("a", None, 0.0), ("b", None, 0.0), ("z", None, 0.0)], "g string, x double, y double")
    got = {r["g"]: r["x"] for r in imp.transform(te).collect()}
    assert got == {"a": 2.0, "b": 3.0, "z": 3.0}   # b's group median is null -> global
    enc = E.fit_target_encoder(tr, ["g"], "y", smoothing=10.0)
    out = {r["y"]: r["g_encoded"] for r in enc.transform(tr.withColumn("y", F.monotonically_increasing_id().cast("double"))).collect()}
    g = 25.0
    assert sorted(out.values()) == pytest.approx(sorted([(2 * 15 + 10 * g) / 12] * 2 + [(30 + 10 * g) / 11, (40 + 10 * g) / 11]))


def test_out_of_fold_encoding(spark):
    rows = [(i, "a" if i % 2 else "b", float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k int, g string, y double")
    out = E.target_encode_oof(df, ["g"], "y", fold=F.pmod(F.col("k"), F.lit(5)).cast("int"))
    got = {r["k"]: r["g_target_enc"] for r in out.collect()}
    for k, g, _ in rows:
        others = [y for kk, gg, y in rows if gg == g and kk % 5 != k % 5]
        assert got[k] == pytest.approx(sum(others) / len(others))


# ---------------------------------------------------------------- uncertainty
def test_interval_matches_numpy(spark):
    preds = [[1.0, 5.0, 2.0, 8.0, 3.0], [10.0, 10.0, 10.0, 10.0, 10.0]]
    df = spark.createDataFrame([(p,) for p in preds], "preds array<double>")
    out = U.interval(df).collect()
    for r, p in zip(out, preds):
        assert r["mean_pred"] == pytest.approx(np.mean(p))
        assert r["std_pred"] == pytest.approx(np.std(p))
        assert r["lower"] == pytest.approx(np.percentile(p, 5))
        assert r["upper"] == pytest.approx(np.percentile(p, 95))


def _bootstrap_frame(spark, n=300):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(n, 3)) * [1, 10, 100]
    X[:, 2] = X[:, 0] * 3 - X[:, 1] if n % 2 else X[:, 2]  # odd n: rank-deficient inputs
    y = X @ [2.0, -1.0, 0.05] + rng.normal(size=n)
    rows = [(i, D0, *map(float, X[i]), float(y[i])) for i in range(n)]
    return X, y, spark.createDataFrame(rows, "key_store int, key_date date, a double, b double, c double, y double")


def _weighted_ridge(X, y, w, alpha):
    mu = (w @ X) / w.sum()
    sd = np.sqrt((w @ (X - mu) ** 2) / w.sum())
    root = np.sqrt(w)[:, None]
    Z, t = (X - mu) / sd * root, (y - (w @ y) / w.sum()) * root[:, 0]
    if alpha:
        Z, t = np.vstack([Z, np.sqrt(alpha) * np.eye(X.shape[1])]), np.append(t, np.zeros(X.shape[1]))
    return np.linalg.lstsq(Z, t, rcond=1e-10)[0] / sd


def _draws(X, keys, n_boot, cell_rows):
    """Multinomial weights by brute force: the canonical tree over the hashes, cell by cell."""
    n = len(keys)
    bits = max(0, math.ceil(math.log2(n / cell_rows))) + 2
    counts = np.bincount((keys >> np.uint64(64 - bits)).astype(int), minlength=1 << bits)
    out = np.zeros((n, n_boot))
    for depth, prefix, draws in U.split_draws(counts, bits, n_boot, 0, cell_rows):
        at = np.flatnonzero((keys >> np.uint64(64 - depth)).astype(int) == prefix) if depth else np.arange(n)
        at = at[np.argsort(keys[at])]
        out[at] = U.cell_draws(len(at), np.array(draws), 0, depth, prefix)
    return out


@pytest.mark.parametrize("n, base", [(300, {"kind": "ridge", "alpha": 10.0}), (301, {"kind": "ols"}), (301, {"kind": "ridge", "alpha": 1.0})])
def test_bootstrap_replicas_equal_weighted_fits(spark, n, base):
    X, y, df = _bootstrap_frame(spark, n)
    X, y = X[:n], y[:n]
    keys = np.array([r[0] for r in df.select(F.xxhash64("key_store", "key_date")).collect()]).view(np.uint64)
    poisson = np.array([[r[0], r[1]] for r in df.select(*[U.poisson_weight(["key_store", "key_date"], F.lit(k)) for k in (0, 1)]).collect()], float)
    for resample, cell, w in (("multinomial", 1 << 16, _draws(X, keys, 2, 1 << 16)), ("multinomial", 40, _draws(X, keys, 2, 40)), ("poisson", 0, poisson)):
        ens = U.bootstrap_fit(df.repartition(3), ["a", "b", "c"], n_boot=2, base=base, resample=resample, cell_rows=cell)
        for k in range(2):
            assert np.allclose(ens.coefs[k], _weighted_ridge(X, y, w[:, k], base.get("alpha", 0.0)), rtol=1e-6, atol=1e-9)
        if resample == "multinomial":
            assert (w.sum(axis=0) == n).all()
            again = U.bootstrap_fit(df.repartition(7), ["a", "b", "c"], n_boot=2, base=base, cell_rows=cell)
            assert np.allclose(again.coefs, ens.coefs, rtol=1e-9)
    with pytest.raises(ValueError):
        U.bootstrap_fit(df, ["a"], base={"kind": "gbt"})


def test_resampled_rows_are_multinomial():
    """Every row is drawn as often as any other (chi-square over rows), and replicas differ."""
    keys = U.mix64(np.arange(1, 1001, dtype=np.uint64))
    for cell_rows in (1 << 16, 60):
        w = _draws(np.zeros((1000, 1)), keys, 200, cell_rows)
        assert (w.sum(axis=0) == 1000).all() and len({tuple(c) for c in w.T}) == 200
        chi = ((w.sum(axis=1) - 200) ** 2 / 200).sum()
        assert abs(chi - 999) < 5 * np.sqrt(2 * 999)
        assert abs((w == 0).mean() - np.exp(-1)) < 0.01  # a row is left out with probability 1 / e


def test_mixed_key_is_the_same_in_spark(spark):
    x = [0, 1, -1, 123456789, -(1 << 63), (1 << 63) - 1, 987654321987]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "v long").select(U.mixed_key(F.col("v"))).collect()]
    assert got == U.mix64(np.array(x, dtype=np.int64).view(np.uint64)).view(np.int64).tolist()


def test_routing_threshold_and_stats(spark):
    df = spark.createDataFrame([(float(i), float(i), 100.0, 200.0) for i in range(1, 11)],
                               "std_pred double, y double, p_fast double, p_accurate double")
    t = U.fit_threshold(df, "std_pred", 80.0)
    assert t == pytest.approx(np.percentile(np.arange(1, 11), 80))
    r = U.route(df, t)
    assert r.where("use_accurate").count() == 2
    s = U.routing_stats(r).first()
    assert s["accurate_model_pct"] == 20.0 and s["p90_uncertainty"] == pytest.approx(np.percentile(np.arange(1, 11), 90))


# ---------------------------------------------------------------- regression penalty mapping
def test_ridge_mapping_matches_closed_form(spark):
    from tillcast.operators import regression as R
    rng = np.random.default_rng(4)
    X = rng.normal(size=(400, 4)) * [1, 5, 20, 0.5]
    y = X @ [3.0, -2.0, 0.5, 10.0] + rng.normal(scale=5.0, size=400) + 50
    df = spark.createDataFrame([(*map(float, X[i]), float(y[i])) for i in range(400)], "a double, b double, c double, d double, y double")
    m = R.fit(df, list("abcd"), {"kind": "ridge", "alpha": 10.0})
    Z = (X - X.mean(0)) / X.std(0)
    ws = np.linalg.solve(Z.T @ Z + 10.0 * np.eye(4), Z.T @ (y - y.mean()))
    assert list(m.model.coefficients) == pytest.approx(list(ws), rel=1e-6)


# ---------------------------------------------------------------- splits / requests / sinks
def test_expanding_folds_bounds(spark):
    from tillcast.operators import splits as V
    df = spark.createDataFrame([(s, D0 + dt.timedelta(days=i)) for s in (2, 1) for i in range(30)], "Store int, Date date")
    out = V.expanding_folds(df, 5).orderBy("row_idx").collect()
    assert [r["row_idx"] for r in out] == list(range(60))
    t = 60 // 6
    for r in out:
        i = r["row_idx"]
        assert r["test_fold"] == ((i - (60 - 5 * t)) // t if i >= 60 - 5 * t else None)
    assert out[0]["Store"] == 1


def test_request_validation_and_batch_source(spark, tmp_path):
    import json
    from tillcast.operators import scoring as P
    from tillcast.sources.requests import read_request_batch
    batch = {"requests": [
        {"store_id": 1, "date": "2024-01-05", "day_of_week": 5, "promo": 1},
        {"store_id": 0, "date": "2024/01/05", "day_of_week": 9, "promo": 1, "store_type": "e", "competition_distance": -1},
    ]}
    (tmp_path / "b.json").write_text(json.dumps(batch, indent=2))
    req = read_request_batch(spark, str(tmp_path / "b.json")).withColumn("request_id", F.monotonically_increasing_id())
    out = P.validate_requests(req).orderBy("store_id").collect()
    assert out[1]["valid"] and out[1]["errors"] == "" and out[1]["assortment"] == "basic"
    assert out[0]["errors"] == "store_id,date,day_of_week,store_type,competition_distance"


def test_report_sinks_roundtrip(spark, tmp_path):
    from tillcast.sources import sinks
    df = spark.createDataFrame([("x", 0.3, "CRITICAL")], "feature string, PSI double, status string")
    sinks.write_json(df, str(tmp_path / "psi"))
    assert sinks.read_json_report(spark, str(tmp_path / "psi")).first()["status"] == "CRITICAL"
    (tmp_path / "arr.json").write_text('[\n {"feature": "a", "PSI": 0.1},\n {"feature": "b", "PSI": 0.2}\n]')
    assert sinks.read_json_report(spark, str(tmp_path / "arr.json")).count() == 2
    sinks.write_csv(df, str(tmp_path / "cmp"))
    assert sinks.read_csv(spark, str(tmp_path / "cmp")).first()["feature"] == "x"


def test_fill_with_train_medians(spark):
    tr = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    med = B.train_medians(tr, ["x"])
    assert med == {"x": 2.0}
    assert [r[0] for r in B.fill_with(tr, med, ["x"]).collect()] == [1.0, 2.0, 10.0, 2.0]


def test_panel_csv_source_fixed_schema(spark, tmp_path):
    from tillcast.sources.tables import read_panel
    csv = ("Store,Date,DayOfWeek,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday,StoreType,Assortment,"
           "CompetitionDistance,Promo2\n1,2024-01-01,1,100.5,10,1,0,0,0,a,basic,,0\n1,2024-01-02,2,NaN,11,1,1,0,0,a,basic,250,0\n")
    (tmp_path / "p.csv").write_text(csv)
    df = read_panel(spark, str(tmp_path / "p.csv"))
    rows = df.orderBy("Date").collect()
    assert dict(df.dtypes)["StateHoliday"] == "string"       # a column of only '0' stays a string
    assert rows[0]["CompetitionDistance"] is None and rows[1]["Sales"] is None   # NaN -> NULL
    assert [r["StateHoliday"] for r in B.holiday_binary(df).collect()] == [0, 0]


def test_artifact_roundtrip(spark, tmp_path):
    from tillcast.sources import sinks
    sinks.save_params(spark, {"threshold": 1.5, "medians": {"a": 2.0}}, str(tmp_path / "params"))
    assert sinks.load_params(spark, str(tmp_path / "params")) == {"threshold": 1.5, "medians": {"a": 2.0}}
    t = spark.createDataFrame([("a", 1.0)], "g string, enc double")
    sinks.save_table(t, str(tmp_path / "enc"))
    assert sinks.load_table(spark, str(tmp_path / "enc")).collect() == t.collect()


def test_batch_scoring_end_to_end(spark, tmp_path):
    """Routing follows the fitted threshold, predictions are clamped at 0,
    unknown stores use the fallback vector, every valid request is scored once."""
    from tillcast.plans.scoring import ACCURATE_LABEL, FAST_LABEL, fit_scorer
    rng = np.random.default_rng(9)
    rows = []
    for s, st in ((1, "a"), (2, "b"), (3, "c")):
        for i in range(200):
            d = dt.date(2023, 1, 1) + dt.timedelta(days=i)
            closed = d.isoweekday() == 7
            sales = 0.0 if closed else float(1000 * s + 100 * (d.isoweekday() == 6) + rng.normal(0, 50))
            rows.append((s, d, d.isoweekday(), sales, 10.0, 0 if closed else 1, int(i % 5 == 0), "0", 0, st, "basic",
                         None if s == 3 else 500.0 * s, s % 2))
    hist = spark.createDataFrame(rows, "Store int, Date date, DayOfWeek int, Sales double, Customers double, Open int, "
                                       "Promo int, StateHoliday string, SchoolHoliday int, StoreType string, "
                                       "Assortment string, CompetitionDistance double, Promo2 int")
    sc = fit_scorer(hist, n_boot=5, accurate_spec={"kind": "gbt", "trees": 3, "depth": 3, "lr": 0.1,
                                                   "subsample": 1.0, "colsample": 1.0, "min_child": 1})
    req = spark.createDataFrame([
        (1, 1, "2023-07-20", 4, 1, "0", 0, "a", "basic", None, 1),
        (2, 2, "2023-05-01", 1, 0, "0", 0, "b", "basic", 100.0, 0),
        (3, 9, "2023-07-20", 4, 0, "0", 0, "a", "basic", None, 0),      # unknown store
        (4, 1, "2023/07/20", 4, 0, "0", 0, "a", "basic", None, 0),      # malformed date: rejected
    ], "request_id long, store_id int, date string, day_of_week int, promo int, state_holiday string, "
       "school_holiday int, store_type string, assortment string, competition_distance double, promo2 int")
    out = {r["request_id"]: r for r in sc.score(req).collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[3]["used_fallback"] and not out[1]["used_fallback"]
    for r in out.values():
        assert r["predicted_sales"] >= 0.0
        assert r["model_used"] == (ACCURATE_LABEL if r["uncertainty"] > sc.threshold else FAST_LABEL)
        assert r["lower_bound"] <= r["upper_bound"]
    # saved and loaded: equal scores; a missing model leaves the other one
    from dataclasses import replace

    from tillcast.sources.sinks import load_scorer, save_scorer
    save_scorer(sc, str(tmp_path / "scorer"))
    again = load_scorer(spark, str(tmp_path / "scorer"))
    assert sorted(again.score(req).collect()) == sorted(out.values())
    for part, label in (({"fast": None}, ACCURATE_LABEL), ({"accurate": None}, FAST_LABEL)):
        save_scorer(replace(sc, **part), str(tmp_path / label[:4]))
        one = load_scorer(spark, str(tmp_path / label[:4])).score(req).collect()
        assert len(one) == 3 and {r["model_used"] for r in one} == {label}
    with pytest.raises(ValueError):
        replace(sc, fast=None, accurate=None).score(req)


def test_as_of_scoring_sees_only_the_past(spark):
    from tillcast.operators import scoring as P
    rows = [(1, D0 + dt.timedelta(days=i), float(i), 10.0, 0, 100.0 + i) for i in range(60)]
    hist = spark.createDataFrame(rows, "Store int, Date date, Sales double, Customers double, Promo2 int, "
                                       "CompetitionDistance double")
    req = spark.createDataFrame([(1, 1, D0 + dt.timedelta(days=40), 0, 0, None)],
                                "request_id long, Store int, Date date, Promo int, SchoolHoliday int, "
                                "CompetitionDistance double")
    parity = P.request_window_features(req, hist).first()
    past = P.request_window_features(req, hist, as_of=True).first()
    assert parity["lag_7"] == past["lag_7"] == 33.0          # history days are real rows either way
    assert parity["CompetitionDistance"] == 159.0            # latest row of the whole history (reference)
    assert past["CompetitionDistance"] == 139.0              # latest row before the request
    assert parity["m"] == 40 and past["m"] == 40


def test_model_matrix_is_29_wide_and_fit_on_train_only(spark):
    from tillcast.plans.training import FEATURES, KEYS, model_frames
    rows = [(s, dt.date(2023, 1, 1) + dt.timedelta(days=i), (dt.date(2023, 1, 1) + dt.timedelta(days=i)).isoweekday(),
             float(100 * s + i), 5.0, 1, i % 2, "0", 0, "ab"[s % 2], "basic", 50.0 * s, 0)
            for s in (1, 2) for i in range(150)]
    panel = spark.createDataFrame(rows, "Store int, Date date, DayOfWeek int, Sales double, Customers double, "
                                        "Open int, Promo int, StateHoliday string, SchoolHoliday int, StoreType string, "
                                        "Assortment string, CompetitionDistance double, Promo2 int")
    md = model_frames(panel)
    assert len(FEATURES) == 29
    assert md.train.columns == [*KEYS, *FEATURES, "y"] and md.test.columns == md.train.columns
    cut = md.train.agg(F.max("key_date")).first()[0]
    assert md.test.agg(F.min("key_date")).first()[0] > cut
    # encodings come from training rows only: changing test-period sales leaves them unchanged
    shifted = panel.withColumn("Sales", F.when(F.col("Date") > F.lit(cut), F.col("Sales") * 10).otherwise(F.col("Sales")))
    md2 = model_frames(shifted)
    enc = lambda m: sorted(m.train.select("StoreType_encoded", "Assortment_encoded").distinct().collect())
    assert enc(md) == enc(md2)


def test_enet_satisfies_kkt(spark):
    from tillcast.operators.factors import segment_factors
    rng = np.random.default_rng(12)
    X = rng.normal(size=(300, 5)) * [1, 3, 10, 0.1, 2]
    X[:, 4] = X[:, 0] * 2 + rng.normal(scale=0.1, size=300)      # collinear pair
    y = X @ [1.0, 0.0, 0.3, 5.0, 0.0] + rng.normal(size=300) + 7
    df = spark.createDataFrame([(*map(float, X[i]), float(y[i])) for i in range(300)], "a double, b double, c double, d double, e double, y double")
    rows = segment_factors(df, list("abcde"), "y", F.lit(0))[0]
    Z = (X - X.mean(0)) / X.std(0)
    for alpha, r in ((0.5, 1.0), (0.5, 0.5)):
        b0, coef = rows.elastic_net(alpha, r)
        w = coef * X.std(0)
        grad = Z.T @ (y - y.mean() - Z @ w) / 300 - alpha * (1 - r) * w   # must lie in alpha*r * subgradient(|w|)
        for j in range(5):
            if abs(w[j]) > 1e-12:
                assert grad[j] == pytest.approx(alpha * r * np.sign(w[j]), abs=1e-8)
            else:
                assert abs(grad[j]) <= alpha * r + 1e-8
        assert b0 == pytest.approx(float(y.mean() - coef @ X.mean(axis=0)), rel=1e-9)


def _numpy_fit(x, y, alpha):
    """Standardised least squares (minimum norm) or ridge on the rows."""
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd <= 1e-12 * np.sqrt((x ** 2).mean(0)), 1.0, sd)
    z = (x - mu) / sd
    z[:, np.abs(z).max(0) < 1e-9] = 0.0
    if alpha:
        z_, y_ = np.vstack([z, np.sqrt(alpha) * np.eye(x.shape[1])]), np.append(y - y.mean(), np.zeros(x.shape[1]))
    else:
        z_, y_ = z, y - y.mean()
    coef = np.linalg.lstsq(z_, y_, rcond=np.finfo(float).eps * max(len(x), 1000))[0] / sd
    return y.mean() - mu @ coef, coef


@pytest.mark.parametrize("alpha", [0.0, 10.0])
def test_folds_and_learning_curve_equal_numpy(spark, alpha):
    """Rank-deficient and constant inputs, prefixes of one entity included."""
    from tillcast.operators import regression as R
    rng = np.random.default_rng(3)
    n = 900
    x = np.column_stack([rng.normal(1e5, 10, n), np.repeat([0.1, 0.3, 0.7], n // 3), rng.normal(size=n), rng.normal(size=n)])
    x = np.column_stack([x, x[:, 2] - x[:, 3], x[:, 1] * 3])        # a combination, and a copy of a column constant per entity
    y = 1e6 + x @ [2.0, 1e4, 30.0, -20.0, 5.0, 0.0] + rng.normal(size=n)
    names = list("abcdef")
    df = spark.createDataFrame([(k // 300, k, *map(float, x[k]), float(y[k])) for k in range(n)],
                               "key_store int, key_date int, " + ", ".join(f"{c} double" for c in names) + ", y double").repartition(5)
    spec = {"kind": "ridge", "alpha": alpha} if alpha else {"kind": "ols"}
    rmse = lambda b0, c, lo, hi: np.sqrt(np.mean((y[lo:hi] - b0 - x[lo:hi] @ c) ** 2))
    got = R.ts_cv(df, names, spec, 5)["cv_rmse_folds"]
    for f, (_, lo, hi) in enumerate(R.V.fold_bounds(n, 5)):
        assert got[f] == pytest.approx(rmse(*_numpy_fit(x[:lo], y[:lo], alpha), lo, hi), rel=1e-6)
    for r in R.learning_curve(df, names, spec).collect():
        train, val = [], []
        for _, lo, hi in R.V.fold_bounds(r["n_rows"], 3):
            fit = _numpy_fit(x[:lo], y[:lo], alpha)
            train.append(rmse(*fit, 0, lo))
            val.append(rmse(*fit, lo, hi))
        assert r["train_rmse"] == pytest.approx(np.mean(train), rel=1e-6) and r["val_rmse"] == pytest.approx(np.mean(val), rel=1e-6)


def test_single_fits_equal_the_same_solver(spark):
    from tillcast.operators import regression as R
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 3)) * [1, 100, 0.01]
    y = x @ [1.0, 0.5, -3.0] + rng.normal(size=200)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    for name in ("LinearRegression", "Ridge (L2)"):
        m = R.fit(df, ["a", "b", "c"], R.MODEL_SPECS[name])
        b0, coef = _numpy_fit(x, y, R.MODEL_SPECS[name].get("alpha", 0.0))
        assert np.allclose(m.model.raw, coef, rtol=1e-9) and m.model.raw_intercept == pytest.approx(b0, rel=1e-9)
        assert m.importances() == pytest.approx(np.abs(coef * x.std(0)).tolist())
        got = m.predict(df).select("p").toPandas()["p"].to_numpy()
        assert np.allclose(np.sort(got), np.sort(b0 + x @ coef))


def test_vif_of_a_combination_is_infinite_and_dropped(spark):
    from tillcast.operators import stats as G
    for seed in range(6):
        rng = np.random.default_rng(seed)
        a, b, d = rng.normal(1e3, 1, 200), rng.normal(size=200), rng.normal(size=200)
        df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, a - b, d, np.ones(200))], "a double, b double, c double, d double, one double")
        vals = dict(zip("abcd", G.vif_values(df, list("abcd"))))
        assert all(vals[k] == float("inf") for k in "abc") and 1 <= vals["d"] < 1.2
        assert G.vif_values(df, ["a", "b", "c"], intercept=False) == [float("inf")] * 3
        out = {r["feature"]: r for r in G.vif_drop(df, list("abcd")).collect()}
        assert sum(r["dropped"] for r in out.values()) == 1 and not out["d"]["dropped"]
        assert G.vif_values(df, ["a", "b", "one"])[2] is None
    z = np.column_stack([a, b, d])
    want = [1 / (1 - np.corrcoef(z[:, j], z[:, [i for i in range(3) if i != j]] @ np.linalg.lstsq(
        np.column_stack([z[:, [i for i in range(3) if i != j]], np.ones(200)]), z[:, j], rcond=None)[0][:2])[0, 1] ** 2) for j in range(3)]
    assert G.vif_values(df, ["a", "b", "d"]) == pytest.approx(want, rel=1e-6)


def test_json_report_in_both_forms(spark, tmp_path):
    from tillcast.sources import sinks
    df = spark.range(20).select("id", F.concat(F.lit("f"), F.col("id")).alias("feature")).repartition(3)
    sinks.write_json(df, str(tmp_path / "lines"))
    assert sorted(r["id"] for r in sinks.read_json_report(spark, str(tmp_path / "lines")).collect()) == list(range(20))
    (tmp_path / "array").mkdir()
    (tmp_path / "array" / "a.json").write_text('[\n {"id": 1},\n {"id": 2}\n]')
    assert sorted(r["id"] for r in sinks.read_json_report(spark, str(tmp_path / "array"), form="array").collect()) == [1, 2]


def test_small_features_are_reported_as_skipped(spark):
    df = spark.range(40).select(F.col("id").cast("double").alias("x"), F.when(F.col("id") < 3, F.col("id")).cast("double").alias("few"),
                                F.lit(None).cast("double").alias("none"))
    psi = {r["feature"]: (r["PSI"], r["status"]) for r in M.psi_report(df, df, ["x", "few", "none"]).collect()}
    assert psi == {"x": (0.0, "OK"), "few": (None, "SKIPPED"), "none": (None, "SKIPPED")}
    ks = {r["feature"]: (r["n_ref"], r["KS_stat"]) for r in M.ks_report(df, df, ["x", "few", "none"]).collect()}
    assert ks == {"x": (40, 0.0), "few": (3, None), "none": (0, None)}


def test_row_index_over_many_entities(spark):
    from tillcast.operators import splits as V
    df = spark.range(500).select((F.col("id") * 7 % 97).alias("Store"), F.col("id").alias("Date")).repartition(6)
    want = sorted((r["Store"], r["Date"]) for r in df.collect())
    got = sorted((r["row_idx"], r["Store"], r["Date"]) for r in V.row_index(df).collect())
    assert got == [(i, *k) for i, k in enumerate(want)]


def test_filters_reach_the_scan(spark):
    from tillcast.sources.tables import store_panel
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    panel = store_panel(spark, "/root/testdata/sf0.001")
    year = plan(panel.where((F.col("Date") >= F.lit("1996-01-01").cast("date")) & (F.col("Date") <= F.lit("1996-12-31").cast("date"))))
    assert "GreaterThanOrEqual(o_orderdate" in year
    assert "o_totalprice" not in plan(panel.select("Store", "Date"))


@pytest.mark.parametrize("most, sketch", [(2_000_000, 10_000), (40, 100), (3, 100), (1, 20)])
def test_selection_in_passes_equals_numpy(spark, most, sketch):
    rng = np.random.default_rng(5)
    data = {"normal": rng.normal(size=4000), "ties": rng.integers(0, 4, 4000).astype(float), "one": np.full(3, 2.5), "wide": rng.exponential(size=4000) ** 5,
            "mostly": np.where(rng.random(4000) < 0.9, 0.0, rng.normal(size=4000))}
    n = max(map(len, data.values()))
    padded = {g: [float(v) for v in x] + [None, float("nan")] * ((n - len(x)) // 2 + 1) for g, x in data.items()}
    df = spark.createDataFrame([(*r, None) for r in zip(*padded.values())], ", ".join(f"`{g}` double" for g in [*data, "a.b"]))
    probs = [0.0, 0.001, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]
    got = {(r["column"], r["pi"]): r["q"] for r in K.select_quantiles(df.repartition(4), [*data, "a.b"], probs, most, sketch).collect()}
    assert len(got) == len(data) * len(probs)
    for g, x in data.items():
        assert np.allclose([got[g, i] for i in range(len(probs))], np.quantile(x, probs), rtol=1e-12), g
    assert K.select_quantiles(df.limit(0), list(data), probs).count() == 0


def test_psi_does_not_collapse_values(spark):
    """Nothing is grouped by value over all rows: the written tables hold a few values per feature."""
    a = spark.range(60_000).select(F.rand(1).alias("x"))
    written = []
    real = M.cut_lineage
    try:
        M.cut_lineage = lambda df: written.append(real(df)) or written[-1]
        out = M.psi_report(a, a, ["x"]).first()
    finally:
        M.cut_lineage = real
    assert out["PSI"] == 0.0 and all(w.count() <= 40 for w in written)


def test_sliced_and_bounded_rank_paths_agree(spark):
    rng = np.random.default_rng(21)
    a = spark.createDataFrame([(float(v), float(w)) for v, w in zip(np.round(rng.normal(0, 1, 2000), 3),
                                                                    rng.exponential(2.0, 2000))], "x double, z double")
    b = spark.createDataFrame([(float(v), float(w)) for v, w in zip(np.round(rng.normal(0.1, 1, 1500), 3),
                                                                    rng.exponential(2.5, 1500))], "x double, z double")
    for fn, few, lots in ((M.psi_report, {}, {"most": 5}), (M.ks_report, {"buckets": 1}, {"buckets": 7})):
        one = {r["feature"]: r for r in fn(a, b, ["x", "z"], **few).collect()}
        many = {r["feature"]: r for r in fn(a, b, ["x", "z"], **lots).collect()}
        for f in ("x", "z"):
            for k in one[f].asDict():
                if isinstance(one[f][k], float):
                    assert many[f][k] == pytest.approx(one[f][k], rel=1e-12, abs=1e-15)
                else:
                    assert many[f][k] == one[f][k]


def test_broadcast_only_behind_a_bound(spark):
    from tillcast.sizing import broadcast_checked
    small = spark.range(10)
    big = spark.range(1000).withColumn("pad", F.repeat(F.lit("x"), 100))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_checked(small))
    # past the bound on rows times width no hint is added: the join will shuffle
    assert not hinted(broadcast_checked(big, max_bytes=100 * 128))
    assert not hinted(broadcast_checked(big, known_rows=10**9))


def test_one_hot_refuses_unbounded_levels(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        E.fit_one_hot(df, ["c"], max_levels=10)
    long = E.fit_one_hot_long(df, ["c"]).transform(df.withColumn("k", F.col("c")), ["k"])  # any number of levels
    assert sorted((r["k"], r["feature"]) for r in long.collect()) == sorted((str(i), f"c_{i}") for i in range(1, 50))
    enc = E.fit_one_hot(spark.createDataFrame([("b",), ("a",), ("c",)], "c string"), ["c"])
    assert enc.levels == {"c": ["b", "c"]}                      # first sorted level dropped


def test_positional_split_and_hash_folds_are_partition_independent(spark):
    from tillcast.operators import splits as V
    df = spark.createDataFrame([(s, D0 + dt.timedelta(days=i)) for s in (3, 1, 2) for i in range(20)], "Store int, Date date")
    a = {(r.Store, r.Date): r.split for r in V.positional_split(df.repartition(7), 0.8).collect()}
    b = {(r.Store, r.Date): r.split for r in V.positional_split(df.coalesce(1), 0.8).collect()}
    assert a == b and sum(v == "train" for v in a.values()) == 48
    assert all(v == "train" for (s, _), v in a.items() if s in (1, 2))
    f1 = sorted(df.repartition(5).select("Store", "Date", E.default_fold(["Store", "Date"]).alias("f")).collect())
    f2 = sorted(df.coalesce(1).select("Store", "Date", E.default_fold(["Store", "Date"]).alias("f")).collect())
    assert f1 == f2


def test_model_compare_query_takes_the_specs_as_they_are(monkeypatch):
    from types import SimpleNamespace

    from tillcast.catalog import model_q

    seen = []
    monkeypatch.setattr(model_q, "_frames", lambda spark, sf: SimpleNamespace(train=None, test=None))
    monkeypatch.setattr(model_q.R, "model_compare", lambda train, test, features, specs=None, cv_folds=5: seen.append(specs))
    model_q.q_model_compare(None, None)
    assert seen[0]["XGBoost"]["trees"] == 500 and seen == [model_q.R.MODEL_SPECS]


def _enumerated_ks(n, m):
    """{reach: P(D * n * m >= reach)} over all orders of two samples without ties."""
    from itertools import combinations
    reaches = []
    for first in combinations(range(n + m), n):
        i = j = top = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in first else (i, j + 1)
            top = max(top, abs(i * m - j * n))
        reaches.append(top)
    return {r: sum(x >= r for x in reaches) / len(reaches) for r in set(reaches)}


def test_exact_ks_p_equals_enumeration(spark):
    rows = [(n, m, r / (n * m), p) for n, m in ((1, 1), (2, 5), (4, 4), (6, 3), (5, 8), (8, 8)) for r, p in _enumerated_ks(n, m).items()]
    df = spark.createDataFrame(rows, "n long, m long, d double, want double")
    got = df.withColumn("got", M.exact_ks_p(F.col("d"), F.col("n"), F.col("m"))).collect()
    assert all(abs(r["got"] - r["want"]) < 1e-12 for r in got)
    a, b = (spark.createDataFrame([(float(v),) for v in x], "x double") for x in (range(12), range(6, 20)))
    few = M.ks_report(a, b, ["x"]).first()
    assert few["KS_stat"] == pytest.approx(0.5, abs=0.08) and 0 < few["p_value"] < 0.1


def test_balanced_folds(spark):
    from tillcast.operators import splits as V
    df = spark.range(1003).withColumn("other", F.col("id") % 7)
    got = {n: {r["id"]: r["fold"] for r in V.balanced_folds(df.repartition(n), ["id"], 5, seed=3).collect()} for n in (1, 4)}
    assert got[1] == got[4] and len(got[1]) == 1003
    sizes = np.bincount(list(got[1].values()))
    assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1
    again = {r["id"]: r["fold"] for r in V.balanced_folds(df, ["id"], 5, seed=4).collect()}
    assert again != got[1]


def test_column_lists_and_top_by_size(spark):
    """B6, B15 and the top rows by absolute value."""
    from tillcast.operators import ordering as O
    from tillcast.operators import profile as P
    df = spark.createDataFrame([(1, 2.5, "a", True), (2, -9.0, "b", False), (3, 4.0, None, True)], "i int, d double, s string, b boolean")
    assert P.numeric_columns(df) == ["i", "d"] and P.string_columns(df) == ["s"]
    assert B.new_columns(df.select("i", "s"), df) == ["d", "b"]
    assert [r["d"] for r in O.top_n_abs(df, "d", 2).collect()] == [-9.0, 4.0]


# ---------------------------------------------------------------- correlations of columns that do not vary
def _flat(spark):
    rows = [(1.0, 2.0, 7.0, None), (2.0, 3.0, 7.0, None), (4.0, 1.0, 7.0, None), (5.0, None, 7.0, None)]
    return spark.createDataFrame(rows, "y double, x double, flat double, none double")


def test_corr_matrix_of_a_column_that_does_not_vary(spark):
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.corr_matrix(_flat(spark), ["y", "x", "flat", "none"], listwise=False).collect()}
    assert len(got) == 16 and math.isclose(got["x", "x"], 1.0)
    assert math.isclose(got["y", "x"], np.corrcoef([1, 2, 4], [2, 3, 1])[0, 1], rel_tol=1e-12)
    assert all(math.isnan(got[p]) for p in [("y", "flat"), ("flat", "x"), ("flat", "flat")])
    assert got["y", "none"] is None and got["none", "none"] is None


def test_corr_rank_of_a_column_that_does_not_vary(spark):
    got = [(r["feature"], r["rank"]) for r in P.corr_rank(_flat(spark), "y", ["x", "flat", "none"]).collect()]
    assert got == [("flat", 1), ("x", 2), ("none", 3)]  # NaN is the largest value, nulls are last


def test_correlation_queries_of_tables_with_an_urgent_order_every_day(spark, tmp_path):
    """Promo does not vary: the queries rank it first, with NaN, as their SQL does."""
    import datetime as dt

    import duckdb
    import __spark_entry__ as entry
    day = lambda k: dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
    orders = [(k * 10 + c, c, 100.0 + (k * 37 + c * 11) % 50, day(k), "1-URGENT") for k in range(20) for c in range(8) if (k + c) % 3]
    tables = {"customer": ([(c, c % 5) for c in range(8)], "c_custkey long, c_nationkey int"),
              "orders": (orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
              "nation": ([(n, n % 3) for n in range(5)], "n_nationkey int, n_regionkey int")}
    with duckdb.connect() as db:
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        for name in ("corr_rank", "corr_pairwise"):
            got = sorted(map(str, (tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).collect())))
            assert got == sorted(map(str, db.execute(entry.oracle_sql()[name]).fetchall()))
            assert any("Promo" in r and "nan" in r for r in got)
