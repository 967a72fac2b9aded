"""Window-feature queries (W1-W8, B9, B10) over the store-day panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import rows, w, with_panel
from tillcast.functions import scalars as S
from tillcast.operators import windows as W
from tillcast.sources.tables import store_panel

_SLOPE_SQL = (f'CASE WHEN count("Sales") OVER {w(rows(-30, -1))} = 30 '
              f'THEN coalesce(regr_slope("Sales", rn) OVER {w(rows(-30, -1))}, 0) ELSE 0 END')


def _rm(n):
    return f'avg("Sales") OVER {w(rows(-n, -1))}'


def _rs(n):
    return f'coalesce(stddev_samp("Sales") OVER {w(rows(-n, -1))}, 0)'


@query("lag_features", with_panel() + f"""
SELECT "Store", "Date", "Sales",
       lag("Sales", 7) OVER {w()} AS lag_7,
       lag("Sales", 14) OVER {w()} AS lag_14,
       lag("Sales", 30) OVER {w()} AS lag_30
FROM panel""")
def q_lag_features(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Sales")
    return W.lag_features(p)


@query("lag_calendar", with_panel() + """
SELECT p."Store", p."Date", p."Sales",
       l7."Sales" AS lag_7, l14."Sales" AS lag_14, l30."Sales" AS lag_30
FROM panel p
LEFT JOIN panel l7 ON l7."Store" = p."Store" AND l7."Date" = p."Date" - 7
LEFT JOIN panel l14 ON l14."Store" = p."Store" AND l14."Date" = p."Date" - 14
LEFT JOIN panel l30 ON l30."Store" = p."Store" AND l30."Date" = p."Date" - 30""")
def q_lag_calendar(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Sales")
    return W.lag_features(p, calendar=True)


@query("rolling_mean", with_panel() + f"""
SELECT "Store", "Date", {srnd(_rm(7))} AS rolling_mean_7, {srnd(_rm(30))} AS rolling_mean_30
FROM panel""")
def q_rolling_mean(spark, sf):
    p = W.rolling_mean(store_panel(spark, sf).select("Store", "Date", "Sales"))
    return p.select("Store", "Date", rnd("rolling_mean_7").alias("rolling_mean_7"),
                    rnd("rolling_mean_30").alias("rolling_mean_30"))


@query("rolling_std", with_panel() + f"""
SELECT "Store", "Date", {srnd(_rs(7))} AS rolling_std_7, {srnd(_rs(30))} AS rolling_std_30
FROM panel""")
def q_rolling_std(spark, sf):
    p = W.rolling_std(store_panel(spark, sf).select("Store", "Date", "Sales"))
    return p.select("Store", "Date", rnd("rolling_std_7").alias("rolling_std_7"),
                    rnd("rolling_std_30").alias("rolling_std_30"))


@query("rolling_strict", with_panel() + f"""
SELECT "Store", "Date",
       CASE WHEN count("Sales") OVER {w(rows(-7, -1))} = 7 THEN {srnd(_rm(7))} END AS "Rolling_Mean_7",
       CASE WHEN count("Sales") OVER {w(rows(-7, -1))} = 7
            THEN {srnd(f'stddev_samp("Sales") OVER {w(rows(-7, -1))}')} END AS "Rolling_STD_7"
FROM panel""")
def q_rolling_strict(spark, sf):
    p = W.rolling_strict(store_panel(spark, sf).select("Store", "Date", "Sales"))
    return p.select("Store", "Date", rnd("Rolling_Mean_7").alias("Rolling_Mean_7"),
                    rnd("Rolling_STD_7").alias("Rolling_STD_7"))


@query("trend_slope", with_panel(f'rp AS (SELECT *, CAST(row_number() OVER {w()} AS DOUBLE) AS rn FROM panel)') + f"""
SELECT "Store", "Date", {srnd(_SLOPE_SQL)} AS trend_slope_30d
FROM rp""")
def q_trend_slope(spark, sf):
    p = W.trend_slope(store_panel(spark, sf).select("Store", "Date", "Sales"))
    return p.select("Store", "Date", rnd("trend_slope_30d").alias("trend_slope_30d"))


@query("backfill", with_panel(f'l AS (SELECT "Store", "Date", lag("Sales", 7) OVER {w()} AS lag_7 FROM panel)') + f"""
SELECT "Store", "Date", first(lag_7 IGNORE NULLS) OVER {w(rows(0, 10**9))} AS lag_7
FROM l""".replace("1000000000 FOLLOWING", "UNBOUNDED FOLLOWING"))
def q_backfill(spark, sf):
    p = W.lag_features(store_panel(spark, sf).select("Store", "Date", "Sales"), lags=(7,))
    return W.backfill(p.select("Store", "Date", "lag_7"), ["lag_7"])


@query("tail_mean", with_panel(f'r AS (SELECT "Store", "Sales", row_number() OVER (PARTITION BY "Store" ORDER BY "Date" DESC) AS rk FROM panel)') + f"""
SELECT "Store", {srnd('coalesce(avg("Sales"), (SELECT median("Sales") FROM panel))')} AS tail_mean
FROM r WHERE rk <= 30 GROUP BY "Store" """)
def q_tail_mean(spark, sf):
    t = W.tail_mean(store_panel(spark, sf))
    return t.select("Store", rnd("tail_mean").alias("tail_mean"))


_FEATURES_SQL = with_panel(f'rp AS (SELECT *, CAST(row_number() OVER {w()} AS DOUBLE) AS rn FROM panel)',
                           f"""f AS (
  SELECT "Store", "Date", "Sales", "Promo", "SchoolHoliday",
         lag("Sales", 7) OVER {w()} AS lag_7,
         lag("Sales", 14) OVER {w()} AS lag_14,
         lag("Sales", 30) OVER {w()} AS lag_30,
         {_rm(7)} AS rolling_mean_7, {_rs(7)} AS rolling_std_7,
         {_rm(30)} AS rolling_mean_30, {_rs(30)} AS rolling_std_30,
         {_SLOPE_SQL} AS trend_slope_30d
  FROM rp)""")


@query("panel_features", _FEATURES_SQL + f"""
SELECT "Store", "Date", "Sales", lag_7, lag_14, lag_30,
       {srnd('rolling_mean_7')} AS rolling_mean_7, {srnd('rolling_std_7')} AS rolling_std_7,
       {srnd('rolling_mean_30')} AS rolling_mean_30, {srnd('rolling_std_30')} AS rolling_std_30,
       {srnd('trend_slope_30d')} AS trend_slope_30d,
       "Promo" * "SchoolHoliday" AS "Promo_x_SchoolHoliday",
       {srnd('rolling_mean_7 - lag_7')} AS sales_momentum
FROM f""")
def q_panel_features(spark, sf):
    f = W.panel_features(store_panel(spark, sf))
    return f.select("Store", "Date", "Sales", "lag_7", "lag_14", "lag_30",
                    *[rnd(c).alias(c) for c in ("rolling_mean_7", "rolling_std_7", "rolling_mean_30",
                                                "rolling_std_30", "trend_slope_30d")],
                    "Promo_x_SchoolHoliday", rnd("sales_momentum").alias("sales_momentum"))


@query("interactions", _FEATURES_SQL + f"""
SELECT "Store", "Date",
       "Promo" * CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS "Promo_x_Weekend",
       "Promo" * CAST(month("Date") AS INTEGER) AS "Promo_x_Month",
       "Promo" * "SchoolHoliday" AS "Promo_x_SchoolHoliday",
       {srnd('rolling_mean_7 - lag_7')} AS sales_momentum
FROM f""")
def q_interactions(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Sales", "Promo", "SchoolHoliday")
    p = W.rolling_mean(W.lag_features(p, lags=(7,)), windows=(7,))
    p = p.withColumns({"IsWeekend": S.is_weekend("Date"), "Month": S.month("Date")})
    out = W.interactions(p)
    return out.select("Store", "Date", "Promo_x_Weekend", "Promo_x_Month", "Promo_x_SchoolHoliday",
                      rnd("sales_momentum").alias("sales_momentum"))


@query("interactions_draft", with_panel() + f"""
SELECT "Store", "Date",
       {srnd(f'CASE WHEN count("Sales") OVER {w(rows(-7, -1))} = 7 THEN {_rm(7)} END - lag("Sales", 7) OVER {w()}')} AS "Sales_Trend",
       "Promo" * "Customers" AS "Promo_Customers",
       "Promo" * CASE WHEN "DayOfWeek" IN (6, 7) THEN 1 ELSE 0 END AS "Weekend_Promo"
FROM panel""")
def q_interactions_draft(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Sales", "Promo", "Customers", "DayOfWeek")
    p = W.lag_features(p, lags=(1, 7, 14), prefix="Sales_Lag_")
    p = W.rolling_strict(p).withColumn("IsWeekend", S.is_weekend_from_dow("DayOfWeek"))
    out = W.interactions_draft(p)
    return out.select("Store", "Date", rnd("Sales_Trend").alias("Sales_Trend"), "Promo_Customers", "Weekend_Promo")
