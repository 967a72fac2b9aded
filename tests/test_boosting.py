"""Boosted trees against a brute-force booster in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import boosting as B
from tillcast.operators import regression as R

SPEC = {"kind": "gbt", "trees": 6, "depth": 3, "lr": 0.3, "subsample": 1.0, "colsample": 1.0, "min_child": 5, "l1": 0.1, "l2": 1.0}


def data(n=400, seed=0):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=n), r.integers(0, 5, n), r.exponential(size=n), r.normal(size=n).round(1)])
    return x, 3 * x[:, 0] + np.where(x[:, 1] > 2, 5.0, 0.0) + x[:, 2] ** 2 + r.normal(scale=0.3, size=n)


def frame(spark, x, y):
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "__idx long, a double, b double, c double, d double, y double")


def quantile_edges(x, bins):
    return [np.unique(np.quantile(x[:, j], [i / bins for i in range(1, bins)])) for j in range(x.shape[1])]


def brute(x, y, spec, edges):
    """Every threshold of every node tried; splits, gains and leaves by node, and the predictions."""
    soft = lambda g: np.sign(g) * max(abs(g) - spec["l1"], 0.0)
    score = lambda g, h: soft(g) ** 2 / (h + spec["l2"])
    p = np.full(len(y), y.mean())
    trees = []
    for _ in range(spec["trees"]):
        g, made, add = p - y, {}, np.zeros(len(y))

        def grow(rows, node, depth):
            best = None
            if depth < spec["depth"]:
                for j, cuts in enumerate(edges):
                    for cut in cuts:
                        left = rows[x[rows, j] <= cut]
                        right = rows[x[rows, j] > cut]
                        if min(len(left), len(right)) < spec["min_child"]:
                            continue
                        gain = score(g[left].sum(), len(left)) + score(g[right].sum(), len(right)) - score(g[rows].sum(), len(rows))
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, j, cut, left, right)
            if best is None:
                made[node] = -soft(g[rows].sum()) / (len(rows) + spec["l2"]) * spec["lr"]
                add[rows] = made[node]
                return
            made[node] = best[:3]
            grow(best[3], 2 * node + 1, depth + 1)
            grow(best[4], 2 * node + 2, depth + 1)

        grow(np.arange(len(y)), 0, 0)
        trees.append(made)
        p = p + add
    return trees, p


def same(a, b):
    return a.base == b.base and all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("feature", "threshold", "value", "gain"))


@pytest.fixture(scope="module")
def table(spark):
    x, y = data()
    return x, y, frame(spark, x, y).cache()


def test_equals_brute_force(table):
    x, y, df = table
    model = B.fit_many(df, list("abcd"), "y", SPEC, [F.lit(True)], bins=16)[0]
    trees, p = brute(x, y, SPEC, quantile_edges(x, 16))
    for t, made in enumerate(trees):
        for node, what in made.items():
            if isinstance(what, tuple):
                assert np.allclose(model.gain[t, node], what[0], rtol=1e-9) and model.feature[t, node] == what[1]
                assert np.isclose(model.threshold[t, node], what[2], rtol=1e-12)
            else:
                assert model.feature[t, node] == -1 and np.isclose(model.value[t, node], what, atol=1e-9)
    assert np.allclose(model.values(x), p, atol=1e-8)
    out = model.predict(df, "p").select("__idx", "p").toPandas().sort_values("__idx")["p"].to_numpy()
    assert np.allclose(out, p, atol=1e-8)


def test_does_not_depend_on_blocks_or_checkpoints(table, monkeypatch):
    x, y, df = table
    spec = SPEC | {"subsample": 0.7, "colsample": 0.6, "trees": 9}
    one = B.fit_many(df, list("abcd"), "y", spec, [F.lit(True)])[0]
    monkeypatch.setattr(B, "CUT", 2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    grid = dict(block_rows=37)
    many = B.fit_many(df.repartition(5), list("abcd"), "y", spec, [F.lit(True)], **grid)[0]
    assert np.array_equal(one.feature, many.feature) and np.allclose(one.value, many.value, atol=1e-9)
    again = B.fit_many(df.repartition(3), list("abcd"), "y", spec, [F.lit(True)], **grid)[0]
    assert np.allclose(many.value, again.value, atol=1e-12) and np.array_equal(many.threshold, again.threshold)
    assert 0 < one.feature.max() and len({tuple(sorted(set(f[f >= 0].tolist()))) for f in one.feature}) > 1  # columns vary by tree


def test_fits_of_one_run_equal_single_runs(table):
    x, y, df = table
    bounds = [120, 250, 400]
    edges = B.bin_edges(df, list("abcd"))
    together = B.fit_many(df, list("abcd"), "y", SPEC, [F.col("__idx") < b for b in bounds])
    for b, model in zip(bounds, together):
        x_, y_ = x[:b], y[:b]
        assert np.isclose(model.base, y_.mean())
        trees, p = brute(x_, y_, SPEC, edges)
        assert np.allclose(model.values(x_), p, atol=1e-8)
    found = B.errors_by(df, together, "y", F.array(*[F.struct(F.lit(m).alias("model"), F.lit("all").alias("side")) for m in range(3)]))
    for m, model in enumerate(together):
        assert found[m, "all"][0] == 400 and np.isclose(found[m, "all"][1], ((model.values(x) - y) ** 2).sum())


def test_staged_errors_and_importances(table):
    x, y, df = table
    model = B.fit_many(df, list("abcd"), "y", SPEC, [F.lit(True)])[0]
    out = {r["trees"]: r for r in B.staged_errors(df, model, every=2).collect()}
    assert sorted(out) == [2, 4, 6]
    p = np.full(len(y), model.base)
    for t in range(6):
        p = p + model.walk(x, t)
        if t + 1 in out:
            assert np.isclose(out[t + 1]["rmse"], np.sqrt(((p - y) ** 2).mean())) and np.isclose(out[t + 1]["mae"], np.abs(p - y).mean())
    gains = [[model.gain[t, n] for t, n in np.argwhere(model.feature == f)] for f in range(4)]
    mean = np.array([np.mean(g) if g else 0 for g in gains])
    assert np.allclose(model.importances(), mean / mean.sum())
    again = B.Trees.of_rows(model.features, model.base, model.feature.shape, model.rows())
    assert same(model, again)


def test_awkward_rows(spark):
    df = spark.createDataFrame([(float(i % 7) if i % 5 else None, float("nan") if i % 3 == 0 else 1.0, float(i % 7)) for i in range(70)]
                               + [(1.0, 1.0, None)], "a double, b double, y double")
    model = B.fit_many(df, ["a", "b"], "y", SPEC | {"min_child": 1}, [F.lit(True), F.lit(False)])
    p = model[0].predict(df).collect()
    assert len(p) == 71 and all(np.isfinite(r["p"]) for r in p)
    assert model[1].feature.max() == -1  # a fit without rows
    constant = spark.createDataFrame([(1.0, 2.0)] * 9, "a double, y double")
    flat = B.fit_many(constant, ["a"], "y", SPEC, [F.lit(True)])[0]
    assert flat.predict(constant).first()["p"] == 2.0
    assert B.fit_many(constant.limit(0), ["a"], "y", SPEC, [F.lit(True)])[0].base == 0.0


def test_folds_and_learning_curve(spark, table):
    x, y, df = table
    df = df.withColumn("key_store", F.lit(1)).withColumn("key_date", F.col("__idx")).drop("__idx")
    spec = SPEC | {"trees": 3}
    got = R.ts_cv(df, list("abcd"), spec, 3)["cv_rmse_folds"]
    for (lo, hi), score in zip([(100, 200), (200, 300), (300, 400)], got):
        m = B.fit_many(df.filter(F.col("key_date") < 300), list("abcd"), "y", spec, [F.col("key_date") < lo])[0]
        assert np.isclose(score, np.sqrt(((m.values(x[lo:hi]) - y[lo:hi]) ** 2).mean()), rtol=0.02)  # bins of the whole run there
    curve = R.learning_curve(df, list("abcd"), spec, sizes=3).collect()
    assert [r["n_rows"] for r in curve] == [100, 220, 400] and all(0 < r["train_rmse"] < r["val_rmse"] for r in curve)
