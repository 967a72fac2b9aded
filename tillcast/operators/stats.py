"""Model metrics and multicollinearity.

Metrics are one grouped aggregate over a long (group, y, p) table, so any
number of models or splits is scored in one pass. VIF regresses every column
on the others: the rows are reduced to their triangular factor in one pass, and
the regressions of that p x p matrix are driver arithmetic.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.operators.factors import CONSTANT, segment_factors

def rmspe(df: DataFrame, y: str = "y", p: str = "p", by=()) -> DataFrame:
    """sqrt(mean(((y - p) / y)^2)) over rows with y != 0."""
    e = F.when(F.col(y) != 0, (F.col(y) - F.col(p)) / F.col(y))
    return df.groupBy(*by).agg(F.sqrt(F.avg(e * e)).alias("RMSPE"))


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by=()) -> DataFrame:
    """RMSE, MAE, R2, RMSPE (y != 0 masked) and MAPE% (y + 1e-8, unmasked).

    R2 = 1 - SSE / SST with SST = n * var_pop(y).
    """
    err = F.col(y) - F.col(p)
    pe = F.when(F.col(y) != 0, err / F.col(y))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("RMSE"),
        F.avg(F.abs(err)).alias("MAE"),
        (F.lit(1.0) - F.sum(err * err) / (F.var_pop(y) * F.count(y))).alias("R2"),
        F.sqrt(F.avg(pe * pe)).alias("RMSPE"),
        (F.avg(F.abs(err / (F.col(y) + F.lit(1e-8)))) * 100).alias("MAPE"),
    )


# ---------------------------------------------------------------- VIF
COLLINEAR = 1e-10  # a column whose residual on the others is this small next to it is a combination of them


def _vif_from_factor(rows: np.ndarray, const) -> list[float | None]:
    """1 / (1 - R^2) per column of a matrix (or of its triangular factor): each column is
    regressed on the others by a rank-revealing solve. inf for a linear combination of
    the others, None for a constant column (``const``)."""
    p = rows.shape[1]
    keep = [j for j in range(p) if not const[j]]
    norms = np.sqrt((rows ** 2).sum(axis=0))
    unit = rows / np.where(norms == 0, 1.0, norms)
    out: list[float | None] = [None] * p
    for j in keep:
        others = [i for i in keep if i != j]
        gap = unit[:, j]
        if others:
            gap = gap - unit[:, others] @ np.linalg.lstsq(unit[:, others], unit[:, j], rcond=COLLINEAR)[0]
        left = float(np.sqrt((gap ** 2).sum()))
        out[j] = float("inf") if left <= COLLINEAR else 1.0 / left ** 2
    return out


def _column_factor(df: DataFrame, cols, intercept: bool) -> tuple[np.ndarray, list[bool]]:
    """(triangular factor of the columns over the listwise-complete rows, centred with an
    intercept, and whether each is constant)."""
    found = segment_factors(df, cols[:-1], cols[-1], F.lit(0))
    if not found:
        return np.zeros((len(cols), len(cols))), [True] * len(cols)
    f = found[0]
    whole = np.sqrt((f.r[:, 1:] ** 2).sum(axis=0))
    if not intercept:
        return f.r[:, 1:], [w == 0 for w in whole]
    return f.centred(), [s <= CONSTANT * w for s, w in zip(np.sqrt((f.centred() ** 2).sum(axis=0)), whole)]


def vif_values(df: DataFrame, cols, intercept: bool = True) -> list[float | None]:
    """VIF per column on the listwise-complete rows: 1 / (1 - R^2) of the column on the
    others, with an intercept or without (notebook form, uncentred). A constant column
    gets NULL, a linear combination of the others inf."""
    return _vif_from_factor(*_column_factor(df, list(cols), intercept))


VIF_SCHEMA = T.StructType([T.StructField("feature", T.StringType()), T.StructField("VIF", T.DoubleType())])


def vif(df: DataFrame, cols, intercept: bool = True) -> DataFrame:
    """(feature, VIF), highest first."""
    vals = vif_values(df, cols, intercept)
    out = df.sparkSession.createDataFrame(list(zip(cols, vals)), VIF_SCHEMA)
    return out.orderBy(F.desc_nulls_last("VIF"), "feature")


def vif_drop(df: DataFrame, cols, threshold: float = 10.0) -> DataFrame:
    """Drop the highest-VIF column one at a time until the max VIF is
    <= threshold or two columns remain.

    The pass over the rows is repeated only when the dropped column held
    nulls (the listwise row set then grows); otherwise the remaining columns
    of the factor are regressed again, driver-side.

    Output: feature, dropped, step (1-based drop order), VIF (at the drop
    for dropped columns, final for kept ones).
    """
    cols = list(cols)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first().asDict()
    current = list(cols)
    rows, const = _column_factor(df, current, True)
    dropped: list[tuple[str, int, float | None]] = []
    while True:
        vals = _vif_from_factor(rows, const)
        ranked = sorted(zip(current, vals), key=lambda t: (-(t[1] if t[1] is not None else -np.inf), t[0]))
        top, top_v = ranked[0]
        if top_v is None or top_v <= threshold or len(current) <= 2:
            final = dict(zip(current, vals))
            break
        at = current.index(top)
        current.remove(top)
        dropped.append((top, len(dropped) + 1, top_v))
        if nulls[top] > 0:
            rows, const = _column_factor(df, current, True)
        else:
            rows, const = np.delete(rows, at, axis=1), const[:at] + const[at + 1:]
    rows = [(c, True, s, v) for c, s, v in dropped] + [(c, False, None, final[c]) for c in current]
    schema = "feature string, dropped boolean, step int, VIF double"
    return df.sparkSession.createDataFrame(rows, schema)
