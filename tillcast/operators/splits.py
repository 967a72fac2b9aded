"""Splits (V1-V3): temporal holdout, positional split and expanding folds.

Row positions over the (entity, date) order are computed without a
single-partition window: per-entity counts (one row per entity) are
prefix-summed by ranges, then joined back and added to the row number inside the
entity, so the row-level window stays partitioned by entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import cut_lineage
from tillcast.sizing import broadcast_checked


def cutoff_date(df: DataFrame, months: int = 3, date: str = "Date") -> Column:
    """max(date) minus ``months`` calendar months (clipped to month end).

    Evaluated once (a max over one column) and returned as a literal, so
    the split predicates reach the scans as pushed filters.
    """
    cut = df.agg(F.add_months(F.max(date), -months)).first()[0]
    return F.lit(cut)


def time_split(df: DataFrame, months: int = 3, date: str = "Date") -> tuple[DataFrame, DataFrame]:
    """V1: train = date <= cutoff, test = date > cutoff."""
    cut = cutoff_date(df, months, date)
    return df.where(F.col(date) <= cut), df.where(F.col(date) > cut)


def label_time_split(df: DataFrame, months: int = 3, date: str = "Date", name: str = "split") -> DataFrame:
    cut = cutoff_date(df, months, date)
    return df.withColumn(name, F.when(F.col(date) <= cut, F.lit("train")).otherwise(F.lit("test")))


def row_index(df: DataFrame, entity: str = "Store", order: str = "Date", name: str = "row_idx") -> DataFrame:
    """0-based global position in (entity, order) order.

    The per-entity counts are range-partitioned by entity and written once;
    sums run inside each range, and only the ranges' totals (one row per
    partition) are summed in one task. The offset table has one row per
    entity; it is broadcast behind a size check and otherwise shuffle-joined.
    """
    counts = df.groupBy(entity).agg(F.count(F.lit(1)).alias("__n"))
    counts = cut_lineage(counts.repartitionByRange(F.col(entity).asc_nulls_first()).withColumn("__range", F.spark_partition_id()))
    before = (Window.unboundedPreceding, -1)
    ranges = counts.groupBy("__range").agg(F.sum("__n").alias("__total"))
    ranges = ranges.select("__range", F.coalesce(F.sum("__total").over(Window.orderBy("__range").rowsBetween(*before)), F.lit(0)).alias("__start"))
    inside = F.coalesce(F.sum("__n").over(Window.partitionBy("__range").orderBy(entity).rowsBetween(*before)), F.lit(0))
    offsets = (counts.withColumn("__off", inside).join(F.broadcast(ranges), "__range")  # a row per partition
               .select(entity, (F.col("__off") + F.col("__start")).alias("__off")))
    rn = F.row_number().over(Window.partitionBy(entity).orderBy(order))
    return (df.withColumn("__rn", rn).join(broadcast_checked(offsets), entity)
            .withColumn(name, (F.col("__off") + F.col("__rn") - 1).cast("long")).drop("__off", "__rn"))


def balanced_folds(df: DataFrame, keys, k: int = 5, seed: int = 0, name: str = "fold", key: Column | None = None) -> DataFrame:
    """Random folds whose sizes differ by one at most: the place in the order of a hash of the row key, modulo ``k``.

    Rows are range-partitioned by the hash and written once; row numbers run inside each range and the ranges' counts
    (one row per partition) are summed, so no task orders all rows and a row's fold does not change with the partitions.
    ``keys`` tell rows apart; ``key``: the 64-bit hash to order by, as signed numbers."""
    order = [F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]) if key is None else key, *[F.col(c) for c in keys]]
    names = [f"__o{i}" for i in range(len(order))]
    rows = df.withColumns(dict(zip(names, order))).repartitionByRange(*names).sortWithinPartitions(*names)
    rows = cut_lineage(rows.withColumn("__at", F.monotonically_increasing_id())).withColumn("__range", F.shiftright("__at", 33))
    ranges = rows.groupBy("__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per partition
    placed = rows.join(F.broadcast(ranges.select("__range", "__first", before.alias("__before"))), "__range")
    place = F.col("__at") - F.col("__first") + F.col("__before")
    return placed.withColumn(name, (place % k).cast("int")).drop("__at", "__range", "__first", "__before", *names)


def positional_split(df: DataFrame, frac: float = 0.8, entity: str = "Store", order: str = "Date",
                     name: str = "split") -> DataFrame:
    """V2: first floor(frac * n) rows in (entity, order) order are train."""
    idx = row_index(df, entity, order, "__idx")
    n = df.agg(F.count(F.lit(1))).scalar()
    return idx.withColumn(name, F.when(F.col("__idx") < F.floor(n * F.lit(frac)), F.lit("train"))
                          .otherwise(F.lit("test"))).drop("__idx")


def expanding_folds(df: DataFrame, k: int = 5, entity: str = "Store", order: str = "Date",
                    idx_name: str = "row_idx", fold_name: str = "test_fold") -> DataFrame:
    """V3: expanding-window folds by row order.

    n rows, test size t = n div (k+1); fold i (0-based) tests rows
    [n - (k-i)t, n - (k-i)t + t) and trains on every earlier row. Rows
    before n - k t are never tested (``test_fold`` null).
    """
    idx = row_index(df, entity, order, idx_name)
    n = df.agg(F.count(F.lit(1))).scalar()
    t = F.floor(n / F.lit(k + 1))
    first = n - t * k
    i = F.col(idx_name)
    fold = F.when((t > 0) & (i >= first), F.floor((i - first) / t)).cast("int")
    return idx.withColumn(fold_name, fold)


def fold_bounds(n: int, k: int) -> list[tuple[int, int, int]]:
    """(fold, test_start, test_end) for n rows and k expanding folds (driver arithmetic only)."""
    t = n // (k + 1)
    return [(i, n - (k - i) * t, n - (k - i) * t + t) for i in range(k)]
