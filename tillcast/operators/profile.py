"""Profiling aggregates (G1-G17): overview, nulls, describe, histograms,
temporal means, promo lift, correlations, box statistics, findings.

All are single-pass aggregates with map-side partial aggregation; wide
results (per-column statistics) are produced in one ``agg`` and turned long
with ``unpivot``/``stack`` rather than one job per column. Quantiles come
from ``ranks`` (exact, no column or group held whole in one task); pass
``accuracy`` to use ``percentile_approx`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.sizing import broadcast_checked
from pyspark.sql import types as T

# Day-of-week labels (1 = Monday).
DOW_NAMES = {1: "Mon", 2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat", 7: "Sun"}


def _quantiles(c: str, probs, accuracy: int | None) -> Column:
    if accuracy:
        return F.percentile_approx(c, list(probs), accuracy)
    return F.percentile(F.col(c), F.array(*[F.lit(float(p)) for p in probs]))


def overview(df: DataFrame, entity: str = "Store", date: str = "Date") -> DataFrame:
    """G1: rows, columns, date range, distinct entities."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("long").alias("n_cols"),
                  F.min(date).alias("date_min"), F.max(date).alias("date_max"),
                  F.countDistinct(entity).alias("n_entities"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage per column, only columns holding nulls."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("__n", f"stack({len(cols)}, {stack}) AS (column, null_count)")
    return (long.where(F.col("null_count") > 0)
            .select("column", "null_count", (F.col("null_count") * 100.0 / F.col("__n")).alias("null_pct")))


def describe(df: DataFrame, cols, accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column.

    Moments come from one aggregate; quartiles from the exact distributed
    ranks (all columns in one unpivoted pass), or ``percentile_approx``
    when ``accuracy`` is given. The two small results (one row per column)
    are joined on the column name.
    """
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"c{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                     F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    moments = wide.select(F.inline(F.array(*rows)))
    if accuracy:
        qa = df.agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}") for i, c in enumerate(cols)])
        q = qa.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[
            F.col(f"q{i}")[k].cast("double").alias(n) for k, n in enumerate(("p25", "p50", "p75"))])
            for i, c in enumerate(cols)])))
    else:
        from tillcast.operators.ranks import column_quantiles
        ql = column_quantiles(df, cols, [0.25, 0.5, 0.75])
        q = ql.groupBy("column").agg(*[F.max(F.when(F.col("pi") == k, F.col("q"))).alias(n)
                                       for k, n in enumerate(("p25", "p50", "p75"))])
    return (moments.join(q, "column", "left")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def center(df: DataFrame, col: str = "Sales") -> DataFrame:
    """Mean and (exact, distributed) median."""
    from tillcast.operators.ranks import scalar_quantile
    med = scalar_quantile(df, col, 0.5)
    return df.agg(F.avg(col).alias("mean")).withColumn("median", F.lit(med).cast("double"))


def histogram(df: DataFrame, col: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram between min and max, last bin closed, empty bins kept.

    Two scalar subqueries give min/max; the bin index is arithmetic, so the
    count is an ordinary grouped aggregate. The bin grid (``bins`` rows) is
    generated from the one-row range and left-joined.
    """
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / F.lit(bins)
    grid = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("bin_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * (F.col("hi") - F.col("lo")) / bins).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count"))
            .where(F.col("lo").isNotNull()))


def histogram_columns(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """G5 for several columns at once (one unpivoted pass): per column, equal-width
    bins between its own min and max, last bin closed, empty bins kept."""
    cols = list(cols)
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "x").where(F.col("x").isNotNull()))
    rng = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))  # one row per column
    x, lo, hi = F.col("x"), F.col("lo"), F.col("hi")
    idx = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((x - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1)))
    counts = (long.join(F.broadcast(rng), "column")  # one row per column of a fixed list
              .groupBy("column", idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["column", "bin"], "left")
            .select("column", "bin", (lo + F.col("bin") * (hi - lo) / bins).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("count")))


def box_stats_columns(df: DataFrame, cols) -> DataFrame:
    """G14 over several numeric columns: the box statistics of each column
    (the column name is the group of one unpivoted pass)."""
    cols = list(cols)
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
    return box_stats(long, "column", "value")


def mean_by(df: DataFrame, keys, col: str = "Sales", name: str = "mean_sales") -> DataFrame:
    """Grouped mean (keys may be expressions)."""
    return df.groupBy(*keys).agg(F.avg(col).alias(name))


def monthly_trend(df: DataFrame, date: str = "Date", col: str = "Sales") -> DataFrame:
    """Mean per calendar month."""
    return mean_by(df, [F.trunc(date, "month").alias("month")], col)


def mean_by_dow(df: DataFrame, dow: str = "DayOfWeek", col: str = "Sales") -> DataFrame:
    """Mean per day of week, with its short name."""
    names = F.create_map(*[x for k, v in DOW_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return mean_by(df, [dow], col).withColumn("day_name", F.element_at(names, F.col(dow)))


def promo_lift(df: DataFrame, flag: str = "Promo", col: str = "Sales") -> DataFrame:
    """Mean with and without the flag and the lift in percent (null when the base is 0)."""
    out = df.agg(F.avg(F.when(F.col(flag) == 0, F.col(col))).alias("mean_no_promo"),
                 F.avg(F.when(F.col(flag) == 1, F.col(col))).alias("mean_promo"))
    base = F.col("mean_no_promo")
    return out.withColumn("lift_pct", F.when(base != 0, (F.col("mean_promo") - base) / base * 100.0))


def correlation(a: str, b: str) -> Column:
    """Pearson correlation of the rows that hold both: null without such a row, NaN where a side does not vary
    (``F.corr`` divides by zero there)."""
    ab = F.sqrt(F.regr_sxx(b, a) * F.regr_syy(b, a))
    return F.when(ab == 0, F.lit(float("nan"))).otherwise(F.regr_sxy(b, a) / ab)


def corr_matrix(df: DataFrame, cols, listwise: bool = True) -> DataFrame:
    """Correlation matrix in long form (col_a, col_b, corr).

    ``listwise`` drops rows with any null among ``cols`` first; otherwise
    each pair uses its complete cases. A column that does not vary has NaN
    with every other and with itself. One aggregate computes the n(n+1)/2 distinct pairs.
    """
    src = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if listwise:
        src = src.dropna()
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = src.agg(*[correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    structs = []
    for i, (a, b) in enumerate(pairs):
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"r{i}").alias("corr")))
        if a != b:
            structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"r{i}").alias("corr")))
    return wide.select(F.inline(F.array(*structs)))


def corr_rank(df: DataFrame, target: str, cols) -> DataFrame:
    """Features ranked by pairwise correlation with ``target`` (descending)."""
    m = corr_matrix(df, [target, *cols], listwise=False)
    from pyspark.sql import Window
    ranked = m.where((F.col("col_a") == target) & (F.col("col_b") != target))
    return ranked.select(F.col("col_b").alias("feature"), F.col("corr"),
                         F.row_number().over(Window.orderBy(F.col("corr").desc_nulls_last(), "col_b")).alias("rank"))


def box_stats(df: DataFrame, group: str, col: str = "Sales", accuracy: int | None = None) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and outlier count per group.

    Two grouped aggregates joined on the group key: quartiles first, then
    whiskers/outliers with the fences attached (the quartile table holds
    one row per group).
    """
    if accuracy:
        q = df.groupBy(group).agg(_quantiles(col, (0.25, 0.5, 0.75), accuracy).alias("q"))
        q = q.select(group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    else:
        from tillcast.operators.ranks import exact_quantiles
        ql = exact_quantiles(df.where(F.col(group).isNotNull()), group, col, [0.25, 0.5, 0.75], buckets=None)
        q = ql.groupBy(group).agg(*[F.max(F.when(F.col("pi") == k, F.col("q"))).alias(n)
                                    for k, n in enumerate(("q1", "median", "q3"))])
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    x = F.col(col)
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    w = (df.select(group, col).where(x.isNotNull()).join(broadcast_checked(q), group)
         .groupBy(group).agg(F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
                             F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n")))
    return q.join(w, group).select(group, "n", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Value frequencies, most frequent first."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "value")


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """2-D equal-width binned counts (the distributed form of a scatter plot)."""
    def idx(c):
        v = F.col(c).cast("double")
        r = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
        lo, hi = r.select("lo").scalar(), r.select("hi").scalar()
        return F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((v - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1))).cast("int")
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(idx(x).alias("x_bin"), idx(y).alias("y_bin")).agg(F.count(F.lit(1)).alias("n")))


def eda_findings(df: DataFrame) -> DataFrame:
    """The EDA findings computed from data (open days only), one row each.

    finding, value, detail: weekend lift %, promo lift %, Customers-Sales
    correlation, CompetitionDistance missing %, store-type order by mean.
    """
    open_df = df.where(F.col("Open") == 1)
    wk = F.col("DayOfWeek").isin(6, 7)
    stats = open_df.agg(
        ((F.avg(F.when(wk, F.col("Sales"))) / F.avg(F.when(~wk, F.col("Sales"))) - 1) * 100).alias("weekend_lift_pct"),
        ((F.avg(F.when(F.col("Promo") == 1, F.col("Sales"))) / F.avg(F.when(F.col("Promo") == 0, F.col("Sales"))) - 1)
         * 100).alias("promo_lift_pct"),
        correlation("Customers", "Sales").alias("customers_sales_corr"),
        (F.count_if(F.col("CompetitionDistance").isNull()) * 100.0 / F.count(F.lit(1))).alias("competition_missing_pct"),
    )
    order = (open_df.groupBy("StoreType").agg(F.avg("Sales").alias("m"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("m"), F.upper("StoreType")))),
                                           lambda s: s.getField("col2")), " > ").alias("detail")))
    nums = stats.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("finding"), F.col(n).alias("value"), F.lit(None).cast("string").alias("detail"))
        for n in ("weekend_lift_pct", "promo_lift_pct", "customers_sales_corr", "competition_missing_pct")])))
    return nums.unionByName(order.select(F.lit("store_type_order").alias("finding"),
                                         F.lit(None).cast("double").alias("value"), "detail"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (from the schema, no data read)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    """Names of string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
