"""Encoders and imputers fitted on training rows only.

``fit(train) -> Fitted``; ``Fitted.transform(df) -> DataFrame``. Fitted
state is a small DataFrame (one row per category, or one row of scalars),
never a driver dict, so it can be written as parquet and reloaded, and it
reaches the rows through a size-checked broadcast join or a scalar
subquery.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions import scalars as S
from tillcast.operators import filters as B
from tillcast.session import cut_lineage
from tillcast.sizing import broadcast_checked

DATE_FEATURES = ["Year", "Month", "WeekOfYear", "DayOfMonth", "IsWeekend", "Quarter",
                 "Month_sin", "Month_cos", "Week_sin", "Week_cos"]


def date_features(df: DataFrame, date: str = "Date", keep_date: bool = False) -> DataFrame:
    """Calendar parts and cyclical encodings; drops the date unless ``keep_date``.

    No-op when the date column is absent.
    """
    if date not in df.columns:
        return df
    d = F.col(date)
    m_sin, m_cos = S.cyclical(S.month(d), 12)
    w_sin, w_cos = S.cyclical(S.iso_week(d), 52)
    out = df.withColumns({
        "Year": S.year(d), "Month": S.month(d), "WeekOfYear": S.iso_week(d), "DayOfMonth": S.day_of_month(d),
        "IsWeekend": S.is_weekend(d), "Quarter": S.quarter(d),
        "Month_sin": m_sin, "Month_cos": m_cos, "Week_sin": w_sin, "Week_cos": w_cos,
    })
    return out if keep_date else out.drop(date)


def date_features_draft(df: DataFrame, date: str = "Date") -> DataFrame:
    """E1 (notebook variant): Year, Month, Day, WeekOfYear, IsWeekend from DayOfWeek; keeps Date."""
    d = F.col(date)
    return df.withColumns({"Year": S.year(d), "Month": S.month(d), "Day": S.day_of_month(d),
                           "WeekOfYear": S.iso_week(d), "IsWeekend": S.is_weekend_from_dow("DayOfWeek")})


# ---------------------------------------------------------------- E2 one-hot
@dataclass
class OneHot:
    """E2 fitted levels: for each column, the sorted training levels minus the first."""
    levels: dict[str, list[str]]

    def transform(self, df: DataFrame, drop_source: bool = True) -> DataFrame:
        cols = {f"{c}_{lvl}": (F.col(c) == F.lit(lvl)).cast("int")
                for c, lvls in self.levels.items() for lvl in lvls}
        out = df.withColumns(cols)
        return out.drop(*self.levels) if drop_source else out


def fit_one_hot(train: DataFrame, cols, max_levels: int = 1000) -> OneHot:
    """Wide form: levels become output columns, so they are needed on the driver and
    must be few. ``fit_one_hot_long`` serves any number of levels."""
    levels = {}
    for c in cols:
        distinct = train.select(c).where(F.col(c).isNotNull()).distinct()
        vals = distinct.limit(max_levels + 1).collect()
        if len(vals) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels: too many columns; use fit_one_hot_long")
        levels[c] = sorted(str(r[0]) for r in vals)[1:]
    return OneHot(levels)


@dataclass
class OneHotLong:
    """E2 for any number of levels: ``levels`` is a table (column, level) of the levels that
    get an indicator; the output has one row per indicator that is set."""
    cols: list[str]
    levels: DataFrame

    def transform(self, df: DataFrame, keys) -> DataFrame:
        """(keys, feature): the set indicators ``column_level`` of every row."""
        long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in self.cols]).unpivot(list(keys), self.cols, "column", "level")
        return (long.join(broadcast_checked(self.levels), ["column", "level"])
                .select(*keys, F.concat_ws("_", "column", "level").alias("feature")))


def fit_one_hot_long(train: DataFrame, cols) -> OneHotLong:
    """Distinct levels per column without the first in sort order. The levels stay a
    table (written once), so their number is not bounded."""
    cols = list(cols)
    long = train.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "level")
    found = long.where(F.col("level").isNotNull()).distinct()
    first = found.groupBy("column").agg(F.min("level").alias("__first"))
    levels = found.join(F.broadcast(first), "column").where(F.col("level") != F.col("__first"))  # one row per named column
    return OneHotLong(cols, cut_lineage(levels.select("column", "level")))


# ---------------------------------------------------------------- E3 scaler
@dataclass
class Scaler:
    """E3 fitted parameters: mean and population std per column (like an
    MLlib StandardScalerModel, the 2p numbers live with the model)."""
    means: dict[str, float]
    stds: dict[str, float]

    @property
    def cols(self) -> list[str]:
        return list(self.means)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(self.means[c])) / F.lit(self.stds[c]) for c in self.means})


def fit_scaler(train: DataFrame, cols) -> Scaler:
    """Mean and population std per column (one aggregate); a zero std becomes 1."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = train.agg(*aggs).first()
    means = {c: float(row[f"{c}__mean"]) if row[f"{c}__mean"] is not None else 0.0 for c in cols}
    stds = {c: float(row[f"{c}__std"]) if row[f"{c}__std"] else 1.0 for c in cols}
    return Scaler(means, stds)


# ---------------------------------------------------------------- E4 group-median imputer
@dataclass
class GroupMedian:
    """E4 fitted state: per-group medians (materialized table) and the global median."""
    target: str
    group: str
    medians: DataFrame
    global_median: float | None
    n_levels: int | None = None   # rows of ``medians``, counted once when fitted

    def transform(self, df: DataFrame) -> DataFrame:
        fill = F.col("__gm_group")
        if self.global_median is not None:
            fill = F.coalesce(fill, F.lit(self.global_median))
        return (df.join(broadcast_checked(self.medians, known_rows=self.n_levels), self.group, "left")
                .withColumn(self.target, F.coalesce(F.col(self.target), fill)).drop("__gm_group")
                .select(*df.columns))


def fit_group_median(train: DataFrame, target: str, group: str, global_fallback: bool = True) -> GroupMedian:
    """Fitting is an action: the per-group table is written to the checkpoint
    folder so every later transform (and its size check) reads it cheaply."""
    from tillcast.operators.ranks import exact_quantiles
    src = train.select(F.col(group).cast("string").alias("__g"), F.col(target).cast("double").alias(target))
    # group medians and the global median in one rank pass: the global rows
    # form one more group (a key no real level can take: levels are non-null)
    both = src.where(F.col("__g").isNotNull()).unionByName(src.select(F.lit(None).cast("string").alias("__g"), target)
                                                           .withColumn("__all", F.lit(True)), allowMissingColumns=True)
    both = both.select(F.when(F.col("__all"), F.lit("\u0000all")).otherwise(F.col("__g")).alias("__g"), target)
    q = cut_lineage(exact_quantiles(both, "__g", target, [0.5], buckets=None).select("__g", "q"))
    glob = None
    if global_fallback:
        row = q.where(F.col("__g") == "\u0000all").first()
        glob = row["q"] if row else None
    levels = train.select(group).where(F.col(group).isNotNull()).distinct()
    med = cut_lineage(levels.join(q.where(F.col("__g") != "\u0000all"),
                                  F.col(group).cast("string") == F.col("__g"), "left")
                      .select(group, F.col("q").alias("__gm_group")))
    return GroupMedian(target, group, med, None if glob is None else float(glob), med.count())


# ---------------------------------------------------------------- E5 smoothed target encoder
@dataclass
class TargetEncoding:
    """E5 fitted state: per column a materialized (level, encoded) table and the global mean."""
    tables: dict[str, DataFrame]
    global_mean: float
    suffix: str = "_encoded"
    drop_source: bool = True
    n_levels: dict[str, int] = field(default_factory=dict)   # rows per table, counted once when fitted

    def transform(self, df: DataFrame) -> DataFrame:
        g = F.lit(self.global_mean)
        out = df
        for c, t in self.tables.items():
            name = f"{c}{self.suffix}"
            out = (out.join(broadcast_checked(t.withColumnRenamed("enc", name), known_rows=self.n_levels.get(c)), c, "left")
                   .withColumn(name, F.coalesce(F.col(name), g)))
            if self.drop_source:
                out = out.drop(c)
        return out


def fit_target_encoder(train: DataFrame, cols, target: str = "y", smoothing: float = 10.0) -> TargetEncoding:
    """(n * mean + m * g) / (n + m) per level, g = mean of the target over train.

    One grouped aggregate per column (sum and count, partial-aggregated
    map-side); unseen and null levels get g at transform time.
    """
    gm = float(train.agg(F.avg(target)).first()[0])
    tables = {}
    for c in cols:
        st = train.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum(target).alias("s"), F.count(target).alias("n"))
        tables[c] = cut_lineage(st.select(
            c, ((F.col("s") + F.lit(smoothing) * F.lit(gm)) / (F.col("n") + F.lit(smoothing))).alias("enc")))
    return TargetEncoding(tables, gm, n_levels={c: t.count() for c, t in tables.items()})


# ---------------------------------------------------------------- E6 out-of-fold target encoder
def default_fold(keys, k: int = 5) -> Column:
    """Deterministic, partition-independent fold id from the row key."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(k)).cast("int")


def target_encode_oof(train: DataFrame, cols, target: str = "y", fold: Column | None = None, k: int = 5,
                      keys=("Store", "Date"), suffix: str = "_target_enc") -> DataFrame:
    """E6 training mode: each row gets the mean target of its level over the
    *other* folds (fallback: mean of all targets). Unsmoothed.

    One aggregate per column on (level, fold); the level total comes from a
    window over that small table (partitioned by level), and the per-fold
    "total minus own fold" is joined back on (level, fold).
    """
    fold = fold if fold is not None else default_fold(keys, k)
    df = train.withColumn("__fold", fold)
    g = F.lit(float(df.agg(F.avg(target)).first()[0]))
    from pyspark.sql import Window
    out = df
    for c in cols:
        st = df.where(F.col(c).isNotNull()).groupBy(c, "__fold").agg(F.sum(target).alias("s"), F.count(target).alias("n"))
        tot = Window.partitionBy(c)
        st = st.select(c, "__fold", (F.sum("s").over(tot) - F.col("s")).alias("os"),
                       (F.sum("n").over(tot) - F.col("n")).alias("on"))
        st = st.select(c, "__fold", F.when(F.col("on") > 0, F.col("os") / F.col("on")).alias(f"{c}{suffix}"))
        out = (out.join(broadcast_checked(st), [c, "__fold"], "left")
               .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), g)))
    return out.drop("__fold")


def fit_target_means(train: DataFrame, cols, target: str = "y") -> TargetEncoding:
    """E6 inference mode: plain per-level means, fallback the global mean."""
    g = float(train.agg(F.avg(target)).first()[0])
    tables = {c: cut_lineage(train.where(F.col(c).isNotNull()).groupBy(c).agg(F.avg(target).alias("enc")))
              for c in cols}
    return TargetEncoding(tables, g, suffix="_target_enc", drop_source=False,
                          n_levels={c: t.count() for c, t in tables.items()})


# ---------------------------------------------------------------- E7 preprocessing chain
@dataclass
class Preprocessor:
    """Drop closed -> date features -> holiday binary -> group-median impute -> target encode."""
    imputer: GroupMedian
    encoder: TargetEncoding
    categorical: list[str] = field(default_factory=lambda: ["StoreType", "Assortment"])

    def transform(self, df: DataFrame) -> DataFrame:
        out = B.drop_closed(df)
        out = date_features(out)
        out = B.holiday_binary(out)
        out = self.imputer.transform(out)
        return self.encoder.transform(out)


def fit_preprocessor(train: DataFrame, target: str = "Sales", categorical=("StoreType", "Assortment"),
                     smoothing: float = 10.0) -> Preprocessor:
    """Fit every stateful step on the open training rows (the target is the
    training Sales of open days)."""
    base = B.holiday_binary(date_features(B.drop_closed(train)))
    imputer = fit_group_median(base, "CompetitionDistance", "StoreType")
    encoder = fit_target_encoder(imputer.transform(base).withColumn("__y", F.col(target)), list(categorical),
                                 "__y", smoothing)
    return Preprocessor(imputer, encoder, list(categorical))

