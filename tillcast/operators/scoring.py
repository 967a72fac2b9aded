"""Batch scoring of request tables against history.

Per request, the reference builds a daily calendar frame ending on the
request date (history first, synthetic rows otherwise, gaps before the
request date filled with a proxy = mean of the store's last 30 history
rows) and computes the panel features on it. The features of the request
row only look back 30 rows, and the frame is gap-free, so here each
distinct (store, request date) explodes into at most 30 look-back days,
equi-joins the history on (store, day) and aggregates the features with
conditional aggregates. Work per request is bounded (30 rows), and many
requests for the same store-day share one frame, which is then joined
back to the requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions import scalars as S
from tillcast.operators import windows as W
from tillcast.sizing import broadcast_checked

# Validation rule names, in check order.
RULES = ["store_id", "date", "day_of_week", "promo", "school_holiday", "store_type", "competition_distance", "promo2"]
STORE_TYPES = ["a", "b", "c", "d"]
LOOKBACK = 30          # deepest feature look-back (lag_30, rolling 30, slope 30)
SPAN_DAYS = 90         # frame span before the request date outside the history range


def validate_requests(req: DataFrame) -> DataFrame:
    """``errors`` (comma-joined failed rules) and ``valid``. DayOfWeek is not
    checked against the date."""
    def bit(c: Column) -> Column:
        return c.isin(0, 1)
    checks = [
        F.col("store_id") >= 1,
        S.valid_iso_date("date"),
        F.col("day_of_week").between(1, 7),
        bit(F.col("promo")),
        bit(F.col("school_holiday")),
        F.col("store_type").isin(*STORE_TYPES),
        F.col("competition_distance").isNull() | (F.col("competition_distance") >= 0),
        bit(F.col("promo2")),
    ]
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in zip(RULES, checks)]),
                      lambda x: x.isNotNull())
    return req.withColumn("errors", F.array_join(failed, ",")).withColumn("valid", F.size(failed) == 0)


def request_to_panel(req: DataFrame) -> DataFrame:
    """A6 projection: request fields renamed to panel columns (Open = 1)."""
    return req.select(
        F.col("request_id"), F.col("store_id").alias("Store"), F.try_to_date(F.col("date"), "yyyy-M-d").alias("Date"),
        F.col("day_of_week").alias("DayOfWeek"), F.lit(1).alias("Open"), F.col("promo").alias("Promo"),
        F.col("state_holiday").alias("StateHoliday"), F.col("school_holiday").alias("SchoolHoliday"),
        F.col("store_type").alias("StoreType"), F.col("assortment").alias("Assortment"),
        F.col("competition_distance").alias("CompetitionDistance"), F.col("promo2").alias("Promo2"))


def history_stats(history: DataFrame, entity: str = "Store", date: str = "Date",
                  global_median: float | None = None) -> DataFrame:
    """Per store: first and last history date and the latest row's fields (J5),
    plus the proxy (W7 mean of the last 30 rows). One row per store."""
    latest = history.groupBy(entity).agg(
        F.min(date).alias("hmin"), F.max(date).alias("hmax"),
        F.max_by(F.struct("CompetitionDistance", "Customers", "Promo2"), F.col(date)).alias("latest"))
    proxy = W.tail_mean(history, LOOKBACK, "Sales", entity, date, name="proxy", fallback=global_median)
    return latest.join(proxy, entity, "left")


def unknown_store(req: DataFrame, history: DataFrame) -> DataFrame:
    """Requests whose store has no history (left anti join)."""
    stores = history.select(F.col("Store").alias("store_id")).distinct()
    return req.join(stores, "store_id", "left_anti")


def global_median(history: DataFrame, col: str = "Sales") -> float | None:
    """Median of all history values (exact, distributed ranks)."""
    from tillcast.operators.filters import train_medians
    return train_medians(history, [col])[col]


def frame_depth(d: Column) -> Column:
    """Rows before the request date in its calendar frame."""
    m_in = F.datediff(d, F.col("hmin"))
    return (F.when(d < F.col("hmin"), F.lit(SPAN_DAYS)).when(d <= F.col("hmax"), m_in)
            .otherwise(F.least(m_in, F.lit(SPAN_DAYS))))


def lookback_values(frames: DataFrame, history: DataFrame, global_median) -> DataFrame:
    """J2 + J4: (Store, d, j, v) for j = 1..min(30, m): the frame's Sales on day
    d - j, history first, else the proxy (else the global median)."""
    steps = F.when(F.col("m") >= 1, F.sequence(F.lit(1), F.least(F.col("m"), F.lit(LOOKBACK)))).otherwise(F.array().cast("array<int>"))
    lb = frames.select("Store", "d", "m", "proxy", F.explode(steps).alias("j")).withColumn("t", F.date_sub("d", F.col("j")))
    h = history.select("Store", F.col("Date").alias("t"), F.col("Sales").alias("hs"))
    return (lb.join(h, ["Store", "t"], "left")
            .withColumn("is_history", F.col("hs").isNotNull())
            .withColumn("v", F.coalesce("hs", "proxy", F.lit(global_median))))


def as_of_stats(frames: DataFrame, history: DataFrame, entity: str = "Store", date: str = "Date") -> DataFrame:
    """As-of join: for each (entity, d) frame, statistics of the history rows
    strictly before d -- the mean of the last 30 rows and the latest row's
    fields -- without a range join.

    History rows carry their running 30-row mean; frames are unioned in,
    ordered before history rows of the same date, and take the last non-null
    value over the preceding rows of their entity (one window, partitioned
    by entity; rows per entity = history days + distinct request dates).
    """
    run = Window.partitionBy(entity).orderBy(date).rowsBetween(-(LOOKBACK - 1), 0)
    h = history.select(entity, F.col(date).alias("__t"), F.lit(1).alias("__k"),
                       F.avg("Sales").over(run).alias("proxy"),
                       F.struct("CompetitionDistance", "Customers", "Promo2").alias("latest"))
    f = frames.select(entity, F.col("d").alias("__t"), F.lit(0).alias("__k"),
                      F.lit(None).cast("double").alias("proxy"), F.lit(None).cast(h.schema["latest"].dataType).alias("latest"))
    w = Window.partitionBy(entity).orderBy("__t", "__k").rowsBetween(Window.unboundedPreceding, 0)
    u = h.unionByName(f).select(entity, "__t", "__k", F.last("proxy", ignorenulls=True).over(w).alias("proxy"),
                                F.last("latest", ignorenulls=True).over(w).alias("latest"))
    return u.where(F.col("__k") == 0).select(entity, F.col("__t").alias("d"), "proxy", "latest")


def request_window_features(req_panel: DataFrame, history: DataFrame, as_of: bool = False) -> DataFrame:
    """Window features at the request date for known-store requests.

    Output per request: request columns + lag_7/14/30, rolling mean/std 7/30,
    trend_slope_30d, sales_momentum, Promo_x_SchoolHoliday, frame depth m,
    and the latest history row's CompetitionDistance/Customers/Promo2.

    ``as_of=True`` uses only history strictly before each request date for
    the proxy, the latest row and the frame (a request with no earlier
    history counts as an unknown store); the default matches the reference,
    whose proxy and latest row come from the whole history.
    """
    gmed = global_median(history)
    hs = history_stats(history, global_median=gmed)
    known = req_panel.join(hs, "Store")
    if as_of:
        past = as_of_stats(known.select("Store", F.col("Date").alias("d")).distinct(), history)
        known = (known.drop("proxy", "latest").join(past.withColumnRenamed("d", "Date"), ["Store", "Date"])
                 .where(F.col("Date") > F.col("hmin"))
                 .withColumn("hmax", F.date_sub("Date", 1)))  # every kept history day precedes the request
    frames = (known.select("Store", F.col("Date").alias("d"), frame_depth(F.col("Date")).alias("m"), "proxy")
              .distinct())
    lv = lookback_values(frames, history, gmed)
    j, v = F.col("j"), F.col("v")

    def within(n):
        return F.when(j <= n, v)

    feats = lv.groupBy("Store", "d", "m").agg(
        *[F.max(F.when(j == k, v)).alias(f"lag_{k}") for k in (7, 14, 30)],
        *[F.avg(within(n)).alias(f"rolling_mean_{n}") for n in (7, 30)],
        *[F.coalesce(F.stddev_samp(within(n)), F.lit(0.0)).alias(f"rolling_std_{n}") for n in (7, 30)],
        F.regr_slope(v, (-j).cast("double")).alias("__slope"))
    feats = feats.withColumn("trend_slope_30d", F.when(F.col("m") >= LOOKBACK, F.coalesce("__slope", F.lit(0.0)))
                             .otherwise(F.lit(0.0))).drop("__slope")
    # frames with no look-back day (request on the first history day) keep null features
    feats = frames.select("Store", "d", "m").join(feats, ["Store", "d", "m"], "left").withColumns({
        "rolling_std_7": F.coalesce("rolling_std_7", F.lit(0.0)), "rolling_std_30": F.coalesce("rolling_std_30", F.lit(0.0)),
        "trend_slope_30d": F.coalesce("trend_slope_30d", F.lit(0.0))})
    out = known.join(feats.withColumnRenamed("d", "Date"), ["Store", "Date"])
    out = out.withColumns({
        "CompetitionDistance": F.coalesce(F.col("CompetitionDistance"), F.col("latest.CompetitionDistance")),
        "sales_momentum": F.col("rolling_mean_7") - F.col("lag_7"),
        "Promo_x_SchoolHoliday": F.col("Promo") * F.col("SchoolHoliday"),
    })
    return out


def dup_keys(df: DataFrame, keys=("Store", "Date")) -> DataFrame:
    """Panel keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def latest_row(history: DataFrame, entity: str = "Store", date: str = "Date", as_of: Column | None = None) -> DataFrame:
    """Latest history row per entity (optionally only rows before ``as_of``)."""
    h = history if as_of is None else history.where(F.col(date) < as_of)
    cols = [c for c in h.columns if c != entity]
    return h.groupBy(entity).agg(F.max_by(F.struct(*cols), F.col(date)).alias("r")).select(entity, "r.*")


def calendar_spine(req_panel: DataFrame, history: DataFrame, depth: int = LOOKBACK) -> DataFrame:
    """Per request, the last ``depth`` frame days before the request date with
    the history value where present, else the proxy; ``is_history`` flags which."""
    gmed = global_median(history)
    hs = history_stats(history, global_median=gmed)
    known = req_panel.join(broadcast_checked(hs), "Store")
    frames = known.select("Store", F.col("Date").alias("d"), frame_depth(F.col("Date")).alias("m"), "proxy").distinct()
    lv = lookback_values(frames, history, gmed)
    back = known.select("request_id", "Store", F.col("Date").alias("d"))
    return back.join(lv, ["Store", "d"]).select("request_id", "Store", F.col("t").alias("Date"), "j", "v", "is_history")


def fallback_rows(unknown: DataFrame, medians: dict, features) -> DataFrame:
    """P5: unknown-store requests get the training-median vector (zeros when a
    median is missing) and ``used_fallback``."""
    return unknown.select("request_id", *[F.lit(float(medians.get(c) or 0.0)).alias(c) for c in features],
                          F.lit(True).alias("used_fallback"))

