"""Per-entity window features over a panel (lags, rolling stats, trend).

Every feature uses the same ``partitionBy(entity).orderBy(date)`` spec, so
the whole set plans to one Exchange on the entity plus one Sort; frames
differ only inside the Window operator.

Scale note: the panel key (entity, date) is unique, so one entity's
partition is bounded by the number of calendar days, not by the raw data
volume. A hot entity in the raw table is collapsed by the aggregation that
builds the panel before it reaches this window.

Lags count rows, not days (parity default). ``calendar=True`` switches the
lags to day offsets through a range frame on the day number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _spec(entity: str, date: str):
    return Window.partitionBy(entity).orderBy(date)


def lag_features(df: DataFrame, lags=(7, 14, 30), target: str = "Sales", entity: str = "Store",
                 date: str = "Date", calendar: bool = False, prefix: str = "lag_") -> DataFrame:
    """Value ``k`` rows (or ``k`` days when ``calendar``) earlier in the same entity."""
    w = _spec(entity, date)
    if not calendar:
        return df.withColumns({f"{prefix}{k}": F.lag(target, k).over(w) for k in lags})
    day = F.unix_date(F.col(date))
    wr = Window.partitionBy(entity).orderBy(day)
    return df.withColumns({
        f"{prefix}{k}": F.first(target).over(wr.rangeBetween(-k, -k)) for k in lags
    })


def rolling_mean(df: DataFrame, windows=(7, 30), target: str = "Sales", entity: str = "Store",
                 date: str = "Date") -> DataFrame:
    """Mean of the previous ``w`` rows (partial windows allowed, first row null)."""
    w = _spec(entity, date)
    return df.withColumns({f"rolling_mean_{n}": F.avg(target).over(w.rowsBetween(-n, -1)) for n in windows})


def rolling_std(df: DataFrame, windows=(7, 30), target: str = "Sales", entity: str = "Store",
                date: str = "Date") -> DataFrame:
    """Sample std of the previous ``w`` rows; fewer than two values gives 0."""
    w = _spec(entity, date)
    return df.withColumns({
        f"rolling_std_{n}": F.coalesce(F.stddev_samp(target).over(w.rowsBetween(-n, -1)), F.lit(0.0))
        for n in windows
    })


def rolling_strict(df: DataFrame, window: int = 7, target: str = "Sales", entity: str = "Store",
                   date: str = "Date", mean_name: str | None = None, std_name: str | None = None) -> DataFrame:
    """Rolling mean/std over the previous ``window`` rows, null unless the window is full."""
    frame = _spec(entity, date).rowsBetween(-window, -1)
    full = F.count(target).over(frame) == window
    return df.withColumns({
        mean_name or f"Rolling_Mean_{window}": F.when(full, F.avg(target).over(frame)),
        std_name or f"Rolling_STD_{window}": F.when(full, F.stddev_samp(target).over(frame)),
    })


def trend_slope(df: DataFrame, window: int = 30, target: str = "Sales", entity: str = "Store",
                date: str = "Date") -> DataFrame:
    """OLS slope of the previous ``window`` values against their position.

    Only a full window of non-null values has a slope; anything else is 0
    (the shifted series starts with a missing value, so the first ``window``
    rows of each entity are 0). ``regr_slope`` is shift-invariant in x, so
    the row number within the entity serves as the position.
    """
    w = _spec(entity, date)
    frame = w.rowsBetween(-window, -1)
    rn = F.row_number().over(w).cast("double")
    tmp = "__tc_rn"
    out = df.withColumn(tmp, rn)
    return out.withColumn(
        f"trend_slope_{window}d",
        F.when(F.count(target).over(frame) == window,
               F.coalesce(F.regr_slope(F.col(target), F.col(tmp)).over(frame), F.lit(0.0)))
         .otherwise(F.lit(0.0)),
    ).drop(tmp)


def backfill(df: DataFrame, cols, entity: str = "Store", date: str = "Date") -> DataFrame:
    """Replace nulls with the next non-null value of the same entity."""
    frame = _spec(entity, date).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumns({c: F.first(c, ignorenulls=True).over(frame) for c in cols})


def tail_mean(df: DataFrame, n: int = 30, target: str = "Sales", entity: str = "Store",
              date: str = "Date", name: str = "tail_mean", fallback: float | None = None) -> DataFrame:
    """Per entity, mean of its last ``n`` rows; entities whose mean is
    null fall back to the global (exact, distributed) median of ``target``.

    The rank filter keeps only ``n`` rows per entity before the aggregate.
    """
    w = Window.partitionBy(entity).orderBy(F.col(date).desc())
    tail = (df.select(entity, date, target).withColumn("__rk", F.row_number().over(w))
            .where(F.col("__rk") <= n).groupBy(entity).agg(F.avg(target).alias(name)))
    from tillcast.operators.ranks import scalar_quantile
    global_median = fallback if fallback is not None else scalar_quantile(df, target, 0.5)  # exact, distributed
    return tail.select(entity, F.coalesce(F.col(name), F.lit(global_median).cast("double")).alias(name))


def interactions(df: DataFrame) -> DataFrame:
    """Interaction terms, each emitted only when its inputs exist."""
    cols = set(df.columns)
    out = {}
    if {"Promo", "IsWeekend"} <= cols:
        out["Promo_x_Weekend"] = F.col("Promo") * F.col("IsWeekend")
    if {"Promo", "Month"} <= cols:
        out["Promo_x_Month"] = F.col("Promo") * F.col("Month")
    if {"Promo", "SchoolHoliday"} <= cols:
        out["Promo_x_SchoolHoliday"] = F.col("Promo") * F.col("SchoolHoliday")
    if {"rolling_mean_7", "lag_7"} <= cols:
        out["sales_momentum"] = F.col("rolling_mean_7") - F.col("lag_7")
    return df.withColumns(out) if out else df


def interactions_draft(df: DataFrame) -> DataFrame:
    """The notebook's interaction set (needs Sales_Lag_7, Rolling_Mean_7, IsWeekend)."""
    cols = set(df.columns)
    out = {}
    if {"Rolling_Mean_7", "Sales_Lag_7"} <= cols:
        out["Sales_Trend"] = F.col("Rolling_Mean_7") - F.col("Sales_Lag_7")
    if {"Promo", "Customers"} <= cols:
        out["Promo_Customers"] = F.col("Promo") * F.col("Customers")
    if {"IsWeekend", "Promo"} <= cols:
        out["Weekend_Promo"] = F.col("IsWeekend") * F.col("Promo")
    return df.withColumns(out) if out else df


def panel_features(df: DataFrame, lags=(7, 14, 30), windows=(7, 30), trend_window: int = 30,
                   target: str = "Sales", entity: str = "Store", date: str = "Date") -> DataFrame:
    """Lags, rolling mean/std, trend slope and interactions in one pass.

    All expressions share one window spec, so the physical plan holds a
    single Exchange(hashpartitioning(entity)) and a single Sort.
    """
    w = _spec(entity, date)
    cols: dict[str, Column] = {}
    for k in lags:
        cols[f"lag_{k}"] = F.lag(target, k).over(w)
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        cols[f"rolling_mean_{n}"] = F.avg(target).over(frame)
        cols[f"rolling_std_{n}"] = F.coalesce(F.stddev_samp(target).over(frame), F.lit(0.0))
    tmp = "__tc_rn"
    frame = w.rowsBetween(-trend_window, -1)
    out = df.withColumn(tmp, F.row_number().over(w).cast("double")).withColumns(cols)
    out = out.withColumn(
        f"trend_slope_{trend_window}d",
        F.when(F.count(target).over(frame) == trend_window,
               F.coalesce(F.regr_slope(F.col(target), F.col(tmp)).over(frame), F.lit(0.0)))
         .otherwise(F.lit(0.0)),
    ).drop(tmp)
    return interactions(out)
