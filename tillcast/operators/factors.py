"""Least squares at scale from triangular factors.

Every task reduces its rows of [1, x, y] to the triangular factor R of a QR
decomposition (numpy per Arrow batch); factors are stacked and decomposed
again until one per segment is left. R has the same column norms, inner
products and singular values as the rows themselves, so means, standard
deviations, rank decisions, fits and errors keep the accuracy of working on the
rows, which moment sums (the squared problem) do not.

A ``Factor`` of several segments is the factor of their stacked factors, so
expanding folds and learning curves need one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_IN = 64             # factors merged by one task of a merge round
CONSTANT = 1e-12        # a column whose spread is this small next to its norm is constant
_EPS = np.finfo(float).eps
_SCHEMA = "seg int, task int, r array<double>"


@dataclass
class Factor:
    """Triangular factor of the columns [1, x_1 .. x_p, y]."""
    r: np.ndarray

    @property
    def n(self) -> float:
        """Number of rows (sum of weights)."""
        return float(self.r[0, 0] ** 2)

    def means(self) -> np.ndarray:
        """Means of [x, y]."""
        return self.r[0, 1:] / self.r[0, 0]

    def centred(self) -> np.ndarray:
        """Factor of the centred columns [x, y]."""
        return self.r[1:, 1:]

    def scales(self) -> np.ndarray:
        """Population standard deviation of each x; 1 for a constant column."""
        c = self.centred()[:, :-1]
        spread = np.sqrt((c ** 2).sum(axis=0))
        whole = np.sqrt((self.r[:, 1:-1] ** 2).sum(axis=0))
        return np.where(spread <= CONSTANT * whole, 1.0, spread / np.sqrt(self.n))

    def standardised(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(factor of the standardised x, matching part of y, scales); constant columns are zero."""
        c, sx = self.centred(), self.scales()
        x = c[:, :-1] / sx
        whole = np.sqrt((self.r[:, 1:-1] ** 2).sum(axis=0))
        x[:, np.sqrt((c[:, :-1] ** 2).sum(axis=0)) <= CONSTANT * whole] = 0.0
        return x, c[:, -1], sx

    def unscale(self, w: np.ndarray, sx: np.ndarray) -> tuple[float, np.ndarray]:
        """(intercept, coefficients) of the original columns from standardised ones."""
        coef, m = w / sx, self.means()
        return float(m[-1] - coef @ m[:-1]), coef

    def ridge(self, alpha: float) -> tuple[float, np.ndarray]:
        """Ridge on standardised columns (||y - Xw - b||^2 + alpha ||w||^2); alpha 0 is
        least squares of minimum norm."""
        x, y, sx = self.standardised()
        if alpha > 0:
            x, y = np.vstack([x, np.sqrt(alpha) * np.eye(x.shape[1])]), np.append(y, np.zeros(x.shape[1]))
        w = np.linalg.lstsq(x, y, rcond=_EPS * max(self.n, 1000.0))[0]
        return self.unscale(w, sx)

    def elastic_net(self, alpha: float, l1_ratio: float, max_iter: int = 5000, tol: float = 1e-12) -> tuple[float, np.ndarray]:
        """1/(2n)||y - Xw - b||^2 + alpha r |w|_1 + alpha (1-r)/2 |w|^2 on standardised columns,
        by cyclic coordinate descent on their Gram matrix."""
        x, y, sx = self.standardised()
        gram, cxy = x.T @ x / self.n, x.T @ y / self.n
        w = np.zeros(len(cxy))
        l1, l2 = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
        for _ in range(max_iter):
            moved = 0.0
            for j in range(len(w)):
                rho = cxy[j] - gram[j] @ w + gram[j, j] * w[j]
                den = gram[j, j] + l2
                new = 0.0 if den == 0 else np.sign(rho) * max(abs(rho) - l1, 0.0) / den
                moved = max(moved, abs(new - w[j]))
                w[j] = new
            if moved <= tol * max(1.0, float(np.max(np.abs(w)))):
                break
        return self.unscale(w, sx)

    def fit(self, spec: dict) -> tuple[float, np.ndarray] | None:
        """(intercept, coefficients) of a linear model spec, or None for another kind."""
        kind = spec["kind"]
        if kind in ("ols", "ridge"):
            return self.ridge(float(spec.get("alpha", 0.0)) if kind == "ridge" else 0.0)
        if kind in ("lasso", "enet"):
            return self.elastic_net(float(spec["alpha"]), 1.0 if kind == "lasso" else float(spec["l1_ratio"]),
                                    int(spec.get("max_iter", 5000)))
        return None

    def sse(self, intercept: float, coef: np.ndarray) -> float:
        """Sum of squared errors of y - (intercept + x coef) over the rows."""
        return float(((self.r @ np.concatenate([[intercept], coef, [-1.0]])) ** 2).sum())


def _reduce(rows: np.ndarray) -> np.ndarray:
    """Square triangular factor of some rows."""
    q = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((q - len(r), q))]) if len(r) < q else r


def stack(parts: Iterable[Factor]) -> Factor:
    """Factor of the rows of several factors together."""
    return Factor(_reduce(np.vstack([p.r for p in parts])))


def segment_factors(df: DataFrame, features, label: str, segment: Column) -> dict[int, Factor]:
    """{segment: Factor} of [1, features, label]; rows with a null there are left out.
    Segments are few (fold bounds), a factor is (p + 2)^2 numbers."""
    cols = [*features, label]
    q = len(cols) + 1
    src = df.select(segment.cast("int").alias("seg"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    names = [f"c{i}" for i in range(len(cols))]
    src = src.dropna(subset=names).withColumn("task", F.spark_partition_id())

    def reduce_rows(batches):
        held: dict[int, np.ndarray] = {}
        task = 0
        for pdf in batches:
            for seg, part in pdf.groupby("seg"):
                task = int(part["task"].iloc[0])
                rows = np.column_stack([np.ones(len(part)), part[names].to_numpy(dtype=float)])
                held[seg] = _reduce(np.vstack([held[seg], rows]) if seg in held else rows)
        yield pd.DataFrame({"seg": np.array(list(held), dtype=np.int32), "task": np.full(len(held), task, dtype=np.int32),
                            "r": [r.ravel() for r in held.values()]})

    return merged_factors(src.mapInPandas(reduce_rows, _SCHEMA), src.rdd.getNumPartitions(), q)


def merged_factors(parts: DataFrame, tasks: int, q: int) -> dict[int, Factor]:
    """{segment: Factor} of partial factors (seg, task, r) of ``tasks`` tasks, merged ``FAN_IN`` at a time."""
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")  # the same order however the rows arrived
        r = _reduce(np.vstack([x.reshape(q, q) for x in pdf["r"]]))
        return pd.DataFrame({"seg": pdf["seg"].iloc[:1], "task": pdf["group"].iloc[:1].astype(np.int32), "r": [r.ravel()]})

    while tasks > FAN_IN:
        parts = parts.withColumn("group", F.floor(F.col("task") / FAN_IN)).groupBy("seg", "group").applyInPandas(merge, _SCHEMA)
        tasks = -(-tasks // FAN_IN)
    rows = parts.withColumn("group", F.lit(0)).groupBy("seg").applyInPandas(merge, _SCHEMA).collect()
    return {r["seg"]: Factor(np.array(r["r"]).reshape(q, q)) for r in rows}


def weighted_factors(rows: np.ndarray, weights: np.ndarray, held: dict[int, np.ndarray]) -> None:
    """Add ``rows`` ([1, x, y]) with the weights of every replica [row, replica] to the replicas' factors."""
    for k in range(weights.shape[1]):
        use = weights[:, k] > 0
        part = rows[use] * np.sqrt(weights[use, k])[:, None]
        held[k] = _reduce(np.vstack([held[k], part]) if k in held else part)


PARTIAL_FACTORS = _SCHEMA
