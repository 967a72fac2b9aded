"""Sort, head, top-k, best-by and distinct.

Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each partition keeps its own k best rows and only
those k x partitions rows reach the final merge, so no global sort of the
input happens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sort_panel(df: DataFrame, keys=("Store", "Date")) -> DataFrame:
    """Final-output sort (range-partitioned by Spark)."""
    return df.orderBy(*keys)


def head_n(df: DataFrame, n: int, keys=("Store", "Date")) -> DataFrame:
    """First ``n`` rows in key order (deterministic head)."""
    return df.orderBy(*keys).limit(n)


def top_n(df: DataFrame, order, n: int, descending: bool = False) -> DataFrame:
    """``n`` rows with the smallest (or largest) ``order`` keys."""
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return df.orderBy(*cols).limit(n)


def top_n_abs(df: DataFrame, col: str, n: int, tie: str | None = None) -> DataFrame:
    """``n`` rows with the largest absolute ``col``."""
    keys = [F.abs(F.col(col)).desc()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*keys).limit(n)


def best_by(df: DataFrame, metric: str, label: str = "model", ascending: bool = True) -> DataFrame:
    """D3: the single row with the lowest (or highest) metric, as a one-row aggregate."""
    key = F.col(metric) if ascending else -F.col(metric)
    pick = F.min_by(F.struct(*df.columns), F.struct(key, F.col(label)))
    return df.agg(pick.alias("best")).select("best.*")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(col).distinct().orderBy(col)


def union_reports(parts) -> DataFrame:
    """Append report rows (by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
