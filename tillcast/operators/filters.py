"""Projections and filters (B1-B15). All are narrow: no shuffle, and the
predicates on scan columns reach the parquet reader as pushed filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions import scalars as S

LEAKAGE_COLS = ("Customers", "Sales")


def drop_closed(df: DataFrame, keep_flag: bool = False) -> DataFrame:
    """B1: keep open days (a null flag is dropped too); drop the flag unless ``keep_flag``."""
    if "Open" not in df.columns:
        return df
    out = df.where(F.col("Open") == 1)
    return out if keep_flag else out.drop("Open")


def filter_isin(df: DataFrame, col: str, values) -> DataFrame:
    """Membership filter; an empty selection means no filter."""
    values = list(values or [])
    return df.where(F.col(col).isin(values)) if values else df


def filter_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Inclusive range filter (either bound optional)."""
    c = F.col(col)
    if lo is not None:
        df = df.where(c >= F.lit(lo).cast(df.schema[col].dataType))
    if hi is not None:
        df = df.where(c <= F.lit(hi).cast(df.schema[col].dataType))
    return df


def select_features(df: DataFrame, target: str = "Sales", drop_entity: bool = True,
                    target_name: str = "y") -> DataFrame:
    """Drop leakage (and id) columns, keeping the target in the same row as ``target_name``."""
    drop = [c for c in LEAKAGE_COLS if c in df.columns]
    if drop_entity and "Store" in df.columns:
        drop.append("Store")
    out = df.withColumn(target_name, F.col(target)) if target in df.columns else df
    return out.drop(*drop)


def dropna_listwise(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null in any of ``subset`` (all columns by default)."""
    return df.dropna(subset=list(subset) if subset else None)


def holiday_binary(df: DataFrame, col: str = "StateHoliday") -> DataFrame:
    """B8: '0' -> 0, anything else (NULL included) -> 1."""
    return df.withColumn(col, S.holiday_binary(col)) if col in df.columns else df


def scenario_scale(df: DataFrame, start, factor_drop: float = 0.3, date: str = "Date",
                   flag: str = "Promo", col: str = "Sales") -> DataFrame:
    """What-if scaling, ``col *= (1 - factor_drop)`` where date >= start and flag = 1."""
    cond = (F.col(date) >= F.lit(start).cast("date")) & (F.col(flag) == 1)
    return df.withColumn(col, F.when(cond, F.col(col) * (1 - factor_drop)).otherwise(F.col(col)))


def train_medians(train: DataFrame, cols, exact: bool = True) -> dict[str, float | None]:
    """Fit part of B12: per-column medians over the training rows.

    Exact medians come from the distributed rank computation (all columns
    in one unpivoted pass, no column's distinct values held in one task);
    ``exact=False`` uses ``percentile_approx``. The result is one number
    per column, kept with the fitted flow like any model parameter.
    """
    from tillcast.operators.ranks import exact_quantiles
    cols = list(cols)
    if not exact:
        row = train.agg(*[F.percentile_approx(c, 0.5, 10_000).cast("double").alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    long = (train.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
    q = exact_quantiles(long, "column", "value", [0.5], buckets=None, n_groups=len(cols))
    got = {r["column"]: r["q"] for r in q.collect()}  # one row per column
    return {c: got.get(c) for c in cols}


def fill_with(df: DataFrame, medians: dict, cols) -> DataFrame:
    """Apply part of B12: ``coalesce(c, median_c)`` with the fitted medians as literals."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in cols
                           if medians.get(c) is not None})


def date_to_epoch(df: DataFrame, col: str = "Date", name: str = "Date_epoch") -> DataFrame:
    """Date as integer days since 1970-01-01."""
    return df.withColumn(name, S.date_to_epoch_days(col))


def clamp_pred(df: DataFrame, col: str, lo: float = 0.0) -> DataFrame:
    """Clamp a prediction from below."""
    return df.withColumn(col, S.clamp_min(col, lo))


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns present in ``after`` but not ``before`` (schema only)."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]
