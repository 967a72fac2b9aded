"""Bootstrap intervals and uncertainty routing.

U1 fits B replicas of a linear base model. The replica weights come from hashes, so
they do not depend on the partitions, in one of two ways:

* ``multinomial`` (default): n draws of n rows, with replacement. The rows are ordered by
  the hash of their key. The draws are split over the hash space by conditional
  binomials, bit by bit, until a cell holds at most ``CELL_ROWS`` rows, and inside a
  cell each draw picks a row. Cells are a canonical tree over the hash, so the
  weights of a row depend on the keys alone, and a replica's weights sum to n exactly.
* ``poisson``: independent Poisson(1) weights, without a shuffle; a replica's size is random.

Each task (or cell) reduces its rows, times the roots of their weights, to one
triangular factor per replica (``operators.factors``); factors are merged in a tree and the
B base models are solved from them, as accurately as from the rows.

U2-U7 are projections over an array of per-replica predictions, so any
ensemble (bootstrap replicas, or a set of baseline forecasters) works.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.factors import PARTIAL_FACTORS, merged_factors, weighted_factors
from tillcast.operators.ranks import exact_quantiles
from tillcast.session import cut_lineage
from tillcast.sizing import broadcast_checked

CELL_ROWS = 1 << 16  # rows of a cell, about, at most
# Multipliers of the 64-bit mixing of keys and draws.
GOLDEN, STEP, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
RIDGE = {"kind": "ridge", "alpha": 10.0}


def _poisson1_thresholds(kmax: int = 19) -> list[float]:
    """CDF of Poisson(1) at 0..kmax-1 (rule: e^-1 * sum 1/i!). At 18 the CDF is 1 to the 53 bits
    of the uniform draw, so the inversion is exact."""
    out, acc = [], 0.0
    for k in range(kmax):
        acc += math.exp(-1.0) / math.factorial(k)
        out.append(acc)
    return out


def poisson_weight(keys, replica: Column, seed: int = 0) -> Column:
    """Poisson(1) draw from a uniform hash of (keys, replica, seed)."""
    h = F.xxhash64(*[F.col(k) for k in keys], replica, F.lit(seed))
    u = h.bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / F.lit(float(1 << 53))
    w = F.lit(0)
    for t in _poisson1_thresholds():
        w = w + (u >= F.lit(t)).cast("int")
    return w


@dataclass
class Ensemble:
    """B linear replicas: intercepts (B,) and coefficients (B, p) in the original feature scale."""
    features: list[str]
    intercepts: list[float]
    coefs: list[list[float]]

    def predictions(self, df: DataFrame, name: str = "preds") -> DataFrame:
        """U2 input: array of the B replica predictions per row (pure projection)."""
        reps = []
        for b0, c in zip(self.intercepts, self.coefs):
            e = F.lit(b0)
            for f, v in zip(self.features, c):
                e = e + F.lit(v) * F.col(f)
            reps.append(e)
        return df.withColumn(name, F.array(*reps))


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def cell_draws(n_rows: int, draws: np.ndarray, seed: int, depth: int, prefix: int) -> np.ndarray:
    """Weights [row, replica] of a cell's rows in hash order; ``draws`` of each replica fall into the cell."""
    out = np.zeros((n_rows, len(draws)), dtype=np.int64)
    for k, d in enumerate(draws.tolist()):
        stream = mix64(np.array([(seed * GOLDEN + (k + 1) * STEP + ((1 << depth) + prefix) * MIX_1) % (1 << 64)], dtype=np.uint64))
        u = mix64(stream + np.arange(1, d + 1, dtype=np.uint64) * np.uint64(GOLDEN))
        at = ((u >> np.uint64(11)).astype(np.float64) / float(1 << 53) * n_rows).astype(np.int64)
        out[:, k] = np.bincount(np.minimum(at, n_rows - 1), minlength=n_rows)
    return out


def split_draws(counts: np.ndarray, bits: int, n_boot: int, seed: int, cell_rows: int) -> list[tuple[int, int, list[int]]]:
    """(depth, prefix, draws per replica) of every cell; ``counts``: rows by the first ``bits`` bits of the hash."""
    sums = [counts]
    while len(sums[-1]) > 1:
        sums.append(sums[-1].reshape(-1, 2).sum(axis=1))
    out, level = [], [(0, 0, np.full(n_boot, counts.sum()))]
    while level:
        deeper = []
        for depth, prefix, draws in level:
            rows = int(sums[bits - depth][prefix])
            if rows == 0:
                continue
            if rows <= cell_rows or depth == bits:
                out.append((depth, prefix, [int(d) for d in draws]))
                continue
            share = sums[bits - depth - 1][2 * prefix] / rows
            left = np.array([np.random.default_rng([seed, k, depth, prefix]).binomial(int(d), share) for k, d in enumerate(draws)])
            deeper += [(depth + 1, 2 * prefix, left), (depth + 1, 2 * prefix + 1, draws - left)]
        level = deeper
    return out


def _hash_cells(rows: DataFrame, n_boot: int, seed: int, cell_rows: int) -> tuple[DataFrame, int]:
    """``rows`` (column key: a 64-bit hash) with the cell, its depth, prefix and draws, and the number of cells."""
    n = rows.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / cell_rows))) + 2  # cells of a quarter of the bound on the average
    first = F.shiftrightunsigned("key", 64 - bits)
    counts = np.zeros(1 << bits, dtype=np.int64)
    for r in rows.groupBy(first.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect():  # a number per cell
        counts[r["at"]] = r["n"]
    cells = split_draws(counts, bits, n_boot, seed, cell_rows)
    table = [(k, d, p, w, at) for k, (d, p, w) in enumerate(cells) for at in range(p << (bits - d), (p + 1) << (bits - d))]
    known = rows.sparkSession.createDataFrame(table, "cell int, depth int, prefix long, draws array<long>, at long")
    return rows.withColumn("at", first).join(broadcast_checked(known, known_rows=len(table)), "at").drop("at"), len(cells)


def mixed_key(key: Column) -> Column:
    """``mix64`` of a long as a Spark expression."""
    def times(x: Column, m: int) -> Column:  # modulo 2^64, by halves: no product overflows in ANSI mode
        low, high = m & 0xFFFFFFFF, m >> 32
        x0, x1 = x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32)

        def part(a: Column, b: int) -> tuple[Column, Column]:  # low and high 32 bits of a 64-bit product
            b0, b1 = b & 0xFFFF, b >> 16
            p0, p1 = a * F.lit(b0), a * F.lit(b1)
            low_ = p0 + F.shiftleft(p1.bitwiseAND(F.lit(0xFFFF)), 16)
            return low_.bitwiseAND(F.lit(0xFFFFFFFF)), (F.shiftrightunsigned(low_, 32) + F.shiftrightunsigned(p1, 16)).bitwiseAND(F.lit(0xFFFFFFFF))

        l0, carry = part(x0, low)
        top = (carry + part(x0, high)[0] + part(x1, low)[0]).bitwiseAND(F.lit(0xFFFFFFFF))
        return F.shiftleft(top, 32).bitwiseOR(l0)
    x = key.cast("long")
    x = times(x.bitwiseXOR(F.shiftrightunsigned(x, 30)), MIX_1)
    x = times(x.bitwiseXOR(F.shiftrightunsigned(x, 27)), MIX_2)
    return x.bitwiseXOR(F.shiftrightunsigned(x, 31))


def bootstrap_fit(train: DataFrame, features, n_boot: int = 30, base: dict | None = None, label: str = "y",
                  keys=("key_store", "key_date"), seed: int = 0, resample: str = "multinomial", key: Column | None = None,
                  cell_rows: int = CELL_ROWS) -> Ensemble:
    """B replicas of the linear model ``base`` (a spec of ``regression.MODEL_SPECS``; ridge with alpha 10 by
    default) on resampled rows. ``key``: a 64-bit hash that tells rows apart (default: of ``keys``). Rows with a
    null input or label are left out before the draw."""
    features, base = list(features), base or RIDGE
    if base["kind"] not in ("ols", "ridge", "lasso", "enet"):
        raise ValueError(f"no bootstrap of a model of kind {base['kind']}")
    names = [f"c{i}" for i in range(len(features) + 1)]
    values = [F.col(f"`{c}`").cast("double").alias(n) for c, n in zip([*features, label], names)]
    q = len(names) + 1

    def design(pdf: pd.DataFrame) -> np.ndarray:
        return np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy(dtype=float)])

    def partial(held: dict[int, np.ndarray], task: int) -> pd.DataFrame:
        return pd.DataFrame({"seg": np.array(list(held), dtype=np.int32), "task": np.full(len(held), task, dtype=np.int32),
                             "r": [r.ravel() for r in held.values()]})

    if resample == "poisson":
        w = F.array(*[poisson_weight(keys, F.lit(r), seed) for r in range(n_boot)]).alias("w")
        src = train.select(*values, w).dropna(subset=names).withColumn("task", F.spark_partition_id())

        def reduce_task(batches):
            held, task = {}, 0
            for pdf in batches:
                if len(pdf):
                    task = int(pdf["task"].iloc[0])
                    weighted_factors(design(pdf), np.stack(pdf["w"].to_numpy()).astype(float), held)
            yield partial(held, task)

        found = merged_factors(src.mapInPandas(reduce_task, PARTIAL_FACTORS), src.rdd.getNumPartitions(), q)
    elif resample == "multinomial":
        key = F.xxhash64(*[F.col(k) for k in keys]) if key is None else key
        src = cut_lineage(train.select(*values, key.alias("key")).dropna(subset=names))
        src, cells = _hash_cells(src, n_boot, seed, cell_rows)

        def reduce_cell(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.iloc[np.lexsort([pdf[c] for c in names[::-1]] + [pdf["key"].to_numpy().view(np.uint64)])]
            first, held = pdf.iloc[0], {}
            w = cell_draws(len(pdf), np.asarray(first["draws"]), seed, int(first["depth"]), int(first["prefix"]))
            weighted_factors(design(pdf), w.astype(float), held)
            return partial(held, int(first["cell"]))

        found = merged_factors(src.groupBy("cell").applyInPandas(reduce_cell, PARTIAL_FACTORS), cells, q)
    else:
        raise ValueError(resample)
    fits = [found[r].fit(base) for r in sorted(found)]
    return Ensemble(features, [float(b0) for b0, _ in fits], [[float(v) for v in c] for _, c in fits])


def interval(df: DataFrame, preds: str = "preds", ci: float = 0.90) -> DataFrame:
    """Mean, population std and linear-interpolated lower/upper
    percentiles ((1-ci)/2 and (1+ci)/2) of the replica predictions."""
    a = F.col(preds)
    n = F.size(a)
    mean = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / n
    out = df.withColumn("mean_pred", mean)
    var = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - F.col("mean_pred")) * (x - F.col("mean_pred"))) / n
    out = out.withColumn("std_pred", F.sqrt(var)).withColumn("__s", F.array_sort(a))

    def pct(q):
        pos = F.lit(q) * (n - 1)
        lo = F.floor(pos).cast("int")
        hi = F.least(lo + 1, n - 1)
        vlo = F.element_at("__s", lo + 1)
        vhi = F.element_at("__s", hi + 1)
        return vlo + (vhi - vlo) * (pos - lo)

    lo_q, hi_q = (1 - ci) / 2, (1 + ci) / 2
    return out.withColumns({"lower": pct(lo_q), "upper": pct(hi_q)}).drop("__s")


def fit_threshold(df: DataFrame, std: str = "std_pred", percentile: float = 80.0) -> float:
    """The ``percentile``-th percentile of the validation uncertainty (exact, distributed)."""
    q = exact_quantiles(df.withColumn("__g", F.lit(0)), "__g", std, [percentile / 100.0], buckets=None, n_groups=1)
    return float(q.first()["q"])


def route(df: DataFrame, threshold, std: str = "std_pred", fast: str = "p_fast",
          accurate: str = "p_accurate") -> DataFrame:
    """U4: std > threshold (strict) uses the accurate prediction, else the fast one.

    Both predictions are columns of the same row: no scatter/merge of rows.
    """
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    use = F.col(std) > t
    return df.withColumns({"use_accurate": use,
                           "prediction": F.when(use, F.col(accurate)).otherwise(F.col(fast))})


def routing_stats(routed: DataFrame, std: str = "std_pred") -> DataFrame:
    """Total, fast %, accurate %, mean uncertainty and its exact 90th percentile."""
    base = routed.agg(F.count(F.lit(1)).alias("total_samples"),
                      (F.avg((~F.col("use_accurate")).cast("double")) * 100).alias("fast_model_pct"),
                      (F.avg(F.col("use_accurate").cast("double")) * 100).alias("accurate_model_pct"),
                      F.avg(std).alias("mean_uncertainty"))
    p90 = fit_threshold(routed, std, 90.0)  # one number
    return base.withColumn("p90_uncertainty", F.lit(p90))


def interval_table(routed: DataFrame, n: int = 200, y: str = "y", order=("key_store", "key_date")) -> DataFrame:
    """The ``n`` rows with the smallest actuals, with bounds and route."""
    return routed.orderBy(F.col(y), *order).limit(n)
