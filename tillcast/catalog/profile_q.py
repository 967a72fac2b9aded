"""Profiling, filter, projection and ordering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import w, rows, with_panel
from tillcast.functions import scalars as S
from tillcast.operators import filters as B
from tillcast.operators import ordering as D
from tillcast.operators import profile as G
from tillcast.operators import windows as W
from tillcast.sources.tables import PANEL_COLUMNS, store_panel

OPEN = 'o AS (SELECT * FROM panel WHERE "Open" = 1)'


def _open(spark, sf):
    return B.drop_closed(store_panel(spark, sf), keep_flag=True)


# ---------------------------------------------------------------- G1-G4
@query("profile_overview", with_panel() + """
SELECT count(*) AS n_rows, CAST(13 AS BIGINT) AS n_cols, min("Date") AS date_min, max("Date") AS date_max,
       count(DISTINCT "Store") AS n_entities
FROM panel""")
def q_profile_overview(spark, sf):
    return G.overview(store_panel(spark, sf))


@query("profile_nulls", with_panel() + " SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
       {srnd(f'count(*) FILTER (WHERE "{c}" IS NULL) * 100.0 / count(*)', 6)} AS null_pct FROM panel"""
    for c in PANEL_COLUMNS) + ") WHERE null_count > 0")
def q_profile_nulls(spark, sf):
    n = G.null_profile(store_panel(spark, sf))
    return n.select("column", "null_count", rnd("null_pct", 6).alias("null_pct"))


_DESC_COLS = ("Sales", "Customers", "CompetitionDistance")


@query("profile_describe", with_panel(OPEN) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS "count", {srnd(f'avg("{c}")')} AS mean,
       {srnd(f'stddev_samp("{c}")')} AS std, CAST(min("{c}") AS DOUBLE) AS "min",
       {srnd(f'quantile_cont("{c}", 0.25)')} AS p25, {srnd(f'quantile_cont("{c}", 0.5)')} AS p50,
       {srnd(f'quantile_cont("{c}", 0.75)')} AS p75, CAST(max("{c}") AS DOUBLE) AS "max" FROM o"""
    for c in _DESC_COLS))
def q_profile_describe(spark, sf):
    d = G.describe(_open(spark, sf), _DESC_COLS)
    return d.select("column", "count", *[rnd(c).alias(c) for c in ("mean", "std")], "min",
                    *[rnd(c).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("sales_center", with_panel(OPEN) + f"""
SELECT {srnd('avg("Sales")')} AS mean, {srnd('median("Sales")')} AS median FROM o""")
def q_sales_center(spark, sf):
    return G.center(_open(spark, sf)).select(rnd("mean").alias("mean"), rnd("median").alias("median"))


# ---------------------------------------------------------------- G5
def _hist_sql(expr, bins):
    return with_panel(OPEN, f"src AS (SELECT {expr} AS x FROM o)", "r AS (SELECT min(x) AS lo, max(x) AS hi FROM src)",
                      f"""c AS (SELECT CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((x - r.lo) * {bins} / (r.hi - r.lo)), {bins - 1}) END AS INTEGER) AS bin,
                             count(*) AS n FROM src, r WHERE x IS NOT NULL GROUP BY 1)""",
                      f"g AS (SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS bin)") + f"""
SELECT g.bin, {srnd(f'r.lo + g.bin * (r.hi - r.lo) / {bins}', 6)} AS bin_lo,
       {srnd(f'r.lo + (g.bin + 1) * (r.hi - r.lo) / {bins}', 6)} AS bin_hi, coalesce(c.n, 0) AS "count"
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin WHERE r.lo IS NOT NULL"""


def _hist(df, col, bins):
    h = G.histogram(df, col, bins)
    return h.select("bin", rnd("bin_lo", 6).alias("bin_lo"), rnd("bin_hi", 6).alias("bin_hi"), "count")


@query("hist_sales", _hist_sql('"Sales"', 60))
def q_hist_sales(spark, sf):
    return _hist(_open(spark, sf), "Sales", 60)


@query("hist_log1p", _hist_sql('ln(1 + "Sales")', 60))
def q_hist_log1p(spark, sf):
    df = _open(spark, sf).select(F.log(F.lit(1.0) + F.col("Sales")).alias("log_sales"))
    return _hist(df, "log_sales", 60)


# ---------------------------------------------------------------- G6-G11
@query("trend_monthly", with_panel(OPEN) + f"""
SELECT CAST(date_trunc('month', "Date") AS DATE) AS "month", {srnd('avg("Sales")')} AS mean_sales FROM o GROUP BY 1""")
def q_trend_monthly(spark, sf):
    return G.monthly_trend(_open(spark, sf)).select("month", rnd("mean_sales").alias("mean_sales"))


@query("mean_by_dow", with_panel(OPEN) + f"""
SELECT "DayOfWeek", (['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'])["DayOfWeek"] AS day_name,
       {srnd('avg("Sales")')} AS mean_sales FROM o GROUP BY 1""")
def q_mean_by_dow(spark, sf):
    return G.mean_by_dow(_open(spark, sf)).select("DayOfWeek", "day_name", rnd("mean_sales").alias("mean_sales"))


@query("mean_by_month", with_panel(OPEN) + f"""
SELECT CAST(month("Date") AS INTEGER) AS "Month", {srnd('avg("Sales")')} AS mean_sales FROM o GROUP BY 1""")
def q_mean_by_month(spark, sf):
    m = G.mean_by(_open(spark, sf), [S.month("Date").alias("Month")])
    return m.select("Month", rnd("mean_sales").alias("mean_sales"))


@query("yoy_month", with_panel(OPEN) + f"""
SELECT CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
       {srnd('avg("Sales")')} AS mean_sales FROM o GROUP BY 1, 2""")
def q_yoy_month(spark, sf):
    m = G.mean_by(_open(spark, sf), [S.year("Date").alias("Year"), S.month("Date").alias("Month")])
    return m.select("Year", "Month", rnd("mean_sales").alias("mean_sales"))


@query("promo_lift", with_panel(OPEN, """l AS (SELECT avg(CASE WHEN "Promo" = 0 THEN "Sales" END) AS p0,
                                               avg(CASE WHEN "Promo" = 1 THEN "Sales" END) AS p1 FROM o)""") + f"""
SELECT {srnd('p0')} AS mean_no_promo, {srnd('p1')} AS mean_promo,
       {srnd('CASE WHEN p0 <> 0 THEN (p1 - p0) / p0 * 100.0 END', 6)} AS lift_pct FROM l""")
def q_promo_lift(spark, sf):
    p = G.promo_lift(_open(spark, sf))
    return p.select(rnd("mean_no_promo").alias("mean_no_promo"), rnd("mean_promo").alias("mean_promo"),
                    rnd("lift_pct", 6).alias("lift_pct"))


@query("mean_by_type", with_panel(OPEN) + f"""
SELECT "StoreType", {srnd('avg("Sales")')} AS mean_sales FROM o GROUP BY 1""")
def q_mean_by_type(spark, sf):
    m = G.mean_by(_open(spark, sf), ["StoreType"]).orderBy(F.desc("mean_sales"))
    return m.select("StoreType", rnd("mean_sales").alias("mean_sales"))


# ---------------------------------------------------------------- G12-G13
_CORR_COLS = ["Sales", "Customers", "CompetitionDistance", "Promo", "SchoolHoliday", "DayOfWeek"]


def _corr_sql(listwise):
    src = "o" if not listwise else "(SELECT * FROM o WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in _CORR_COLS) + ")"
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            x, y = sorted([a, b], key=_CORR_COLS.index)
            parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
                {srnd(f'corr(CAST("{x}" AS DOUBLE), CAST("{y}" AS DOUBLE))', 6)} AS "corr" FROM {src}""")
    return with_panel(OPEN) + " UNION ALL ".join(parts)


@query("corr_listwise", _corr_sql(True))
def q_corr_listwise(spark, sf):
    m = G.corr_matrix(_open(spark, sf), _CORR_COLS, listwise=True)
    return m.select("col_a", "col_b", rnd("corr", 6).alias("corr"))


@query("corr_pairwise", _corr_sql(False))
def q_corr_pairwise(spark, sf):
    m = G.corr_matrix(_open(spark, sf), _CORR_COLS, listwise=False)
    return m.select("col_a", "col_b", rnd("corr", 6).alias("corr"))


@query("corr_rank", with_panel(OPEN, "c AS (" + " UNION ALL ".join(
    f"""SELECT '{b}' AS feature, corr("Sales", CAST("{b}" AS DOUBLE)) AS r FROM o""" for b in _CORR_COLS[1:]) + ")") + f"""
SELECT feature, {srnd('r', 6)} AS "corr", row_number() OVER (ORDER BY r DESC NULLS LAST, feature) AS "rank" FROM c""")
def q_corr_rank(spark, sf):
    r = G.corr_rank(_open(spark, sf), "Sales", _CORR_COLS[1:])
    return r.select("feature", rnd("corr", 6).alias("corr"), F.col("rank").cast("long").alias("rank"))


# ---------------------------------------------------------------- G14-G17
@query("box_stats", with_panel(OPEN, """q AS (SELECT "Assortment", quantile_cont("Sales", 0.25) AS q1,
        quantile_cont("Sales", 0.5) AS med, quantile_cont("Sales", 0.75) AS q3 FROM o GROUP BY 1)""",
                                "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)") + f"""
SELECT f."Assortment", count(*) AS n, {srnd('f.q1')} AS q1, {srnd('f.med')} AS median, {srnd('f.q3')} AS q3,
       min(CASE WHEN o."Sales" >= lo_f AND o."Sales" <= hi_f THEN o."Sales" END) AS whisker_lo,
       max(CASE WHEN o."Sales" >= lo_f AND o."Sales" <= hi_f THEN o."Sales" END) AS whisker_hi,
       count(*) FILTER (WHERE NOT (o."Sales" >= lo_f AND o."Sales" <= hi_f)) AS n_outliers
FROM o JOIN f ON o."Assortment" = f."Assortment" GROUP BY f."Assortment", f.q1, f.med, f.q3""")
def q_box_stats(spark, sf):
    b = G.box_stats(_open(spark, sf), "Assortment")
    return b.select("Assortment", "n", rnd("q1").alias("q1"), rnd("median").alias("median"), rnd("q3").alias("q3"),
                    "whisker_lo", "whisker_hi", "n_outliers")


@query("value_counts", with_panel() + """
SELECT "StateHoliday" AS value, count(*) AS "count" FROM panel GROUP BY 1""")
def q_value_counts(spark, sf):
    return G.value_counts(store_panel(spark, sf), "StateHoliday")


@query("eda_findings", with_panel(OPEN, """s AS (SELECT
   (avg(CASE WHEN "DayOfWeek" IN (6, 7) THEN "Sales" END) / avg(CASE WHEN "DayOfWeek" NOT IN (6, 7) THEN "Sales" END) - 1) * 100 AS weekend_lift_pct,
   (avg(CASE WHEN "Promo" = 1 THEN "Sales" END) / avg(CASE WHEN "Promo" = 0 THEN "Sales" END) - 1) * 100 AS promo_lift_pct,
   corr("Customers", "Sales") AS customers_sales_corr,
   count(*) FILTER (WHERE "CompetitionDistance" IS NULL) * 100.0 / count(*) AS competition_missing_pct FROM o)""",
                                   """t AS (SELECT string_agg(upper("StoreType"), ' > ' ORDER BY m DESC, upper("StoreType")) AS detail
        FROM (SELECT "StoreType", avg("Sales") AS m FROM o GROUP BY 1))""") + " UNION ALL ".join(
    f"SELECT '{n}' AS finding, {srnd(n, 6)} AS value, CAST(NULL AS VARCHAR) AS detail FROM s"
    for n in ("weekend_lift_pct", "promo_lift_pct", "customers_sales_corr", "competition_missing_pct"))
    + " UNION ALL SELECT 'store_type_order', CAST(NULL AS DOUBLE), detail FROM t")
def q_eda_findings(spark, sf):
    f = G.eda_findings(store_panel(spark, sf, materialize=True))
    return f.select("finding", rnd("value", 6).alias("value"), "detail")


@query("scatter_binned", with_panel(OPEN, """r AS (SELECT min("Sales") AS xl, max("Sales") AS xh,
        min("Customers") AS yl, max("Customers") AS yh FROM o)""") + """
SELECT CAST(CASE WHEN xh = xl THEN 0 ELSE least(floor(("Sales" - xl) * 20 / (xh - xl)), 19) END AS INTEGER) AS x_bin,
       CAST(CASE WHEN yh = yl THEN 0 ELSE least(floor(("Customers" - yl) * 20 / (yh - yl)), 19) END AS INTEGER) AS y_bin,
       count(*) AS n
FROM o, r WHERE "Sales" IS NOT NULL AND "Customers" IS NOT NULL GROUP BY 1, 2""")
def q_scatter_binned(spark, sf):
    return G.binned_scatter(_open(spark, sf), "Sales", "Customers", 20)


# ---------------------------------------------------------------- B filters / projections
_PANEL_SEL = ", ".join(f'"{c}"' for c in PANEL_COLUMNS)


@query("drop_closed", with_panel() + "SELECT * EXCLUDE (\"Open\") FROM panel WHERE \"Open\" = 1")
def q_drop_closed(spark, sf):
    return B.drop_closed(store_panel(spark, sf))


@query("filter_isin", with_panel() + 'SELECT * FROM panel WHERE "Store" IN (1, 5, 9)')
def q_filter_isin(spark, sf):
    return B.filter_isin(store_panel(spark, sf), "Store", [1, 5, 9])


@query("filter_date_range", with_panel() + """SELECT * FROM panel WHERE "Date" BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def q_filter_date_range(spark, sf):
    return B.filter_range(store_panel(spark, sf), "Date", "1996-01-01", "1996-12-31")


@query("select_features", with_panel() + 'SELECT * EXCLUDE ("Customers", "Sales", "Store"), "Sales" AS y FROM panel')
def q_select_features(spark, sf):
    return B.select_features(store_panel(spark, sf))


@query("dropna_listwise", with_panel() + 'SELECT * FROM panel WHERE "CompetitionDistance" IS NOT NULL')
def q_dropna_listwise(spark, sf):
    return B.dropna_listwise(store_panel(spark, sf))


@query("holiday_binary", with_panel() + """
SELECT "Store", "Date", CASE WHEN "StateHoliday" IS NOT DISTINCT FROM '0' THEN 0 ELSE 1 END AS "StateHoliday" FROM panel""")
def q_holiday_binary(spark, sf):
    return B.holiday_binary(store_panel(spark, sf).select("Store", "Date", "StateHoliday"))


@query("scenario_scale", with_panel() + """
SELECT "Store", "Date", "Promo",
       CASE WHEN "Date" >= DATE '1998-01-01' AND "Promo" = 1 THEN "Sales" * (1 - 0.3) ELSE "Sales" END AS "Sales" FROM panel""")
def q_scenario_scale(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Promo", "Sales")
    return B.scenario_scale(p, "1998-01-01", 0.3)


_MED_COLS = ("lag_7", "lag_14", "lag_30", "rolling_mean_7")


@query("fill_train_median", with_panel(f"""f AS (SELECT "Store", "Date", lag("Sales", 7) OVER {w()} AS lag_7,
        lag("Sales", 14) OVER {w()} AS lag_14, lag("Sales", 30) OVER {w()} AS lag_30,
        avg("Sales") OVER {w(rows(-7, -1))} AS rolling_mean_7 FROM panel)""",
                                          "m AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in _MED_COLS)
                                          + " FROM f WHERE \"Date\" <= DATE '1998-05-02')") + 'SELECT "Store", "Date", ' + ", ".join(
    f"{srnd(f'coalesce(f.{c}, m.{c})')} AS {c}" for c in _MED_COLS) + " FROM f CROSS JOIN m")
def q_fill_train_median(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date", "Sales")
    f = W.rolling_mean(W.lag_features(p), windows=(7,)).drop("Sales", "rolling_mean_30")
    med = B.train_medians(f.where(F.col("Date") <= F.lit("1998-05-02").cast("date")), _MED_COLS)
    out = B.fill_with(f, med, _MED_COLS)
    return out.select("Store", "Date", *[rnd(c).alias(c) for c in _MED_COLS])


@query("date_to_epoch", with_panel() + """SELECT "Store", "Date", CAST("Date" - DATE '1970-01-01' AS INTEGER) AS "Date_epoch" FROM panel""")
def q_date_to_epoch(spark, sf):
    return B.date_to_epoch(store_panel(spark, sf).select("Store", "Date"))


@query("clamp_pred", with_panel() + f"""
SELECT "Store", "Date", greatest(0.0, 2 * lag("Sales", 7) OVER {w()} - lag("Sales", 14) OVER {w()}) AS pred FROM panel""")
def q_clamp_pred(spark, sf):
    p = W.lag_features(store_panel(spark, sf).select("Store", "Date", "Sales"), lags=(7, 14))
    p = p.select("Store", "Date", (2 * F.col("lag_7") - F.col("lag_14")).alias("pred"))
    return B.clamp_pred(p, "pred")


# ---------------------------------------------------------------- D ordering
@query("sort_panel", with_panel() + 'SELECT * FROM panel ORDER BY "Store", "Date"')
def q_sort_panel(spark, sf):
    return D.sort_panel(store_panel(spark, sf))


@query("head_n", with_panel() + 'SELECT * FROM panel ORDER BY "Store", "Date" LIMIT 200')
def q_head_n(spark, sf):
    return D.head_n(store_panel(spark, sf), 200)


@query("top_n", with_panel(OPEN) + 'SELECT "Store", "Date", "Sales" FROM o ORDER BY "Sales", "Store", "Date" LIMIT 200')
def q_top_n(spark, sf):
    return D.top_n(_open(spark, sf).select("Store", "Date", "Sales"), ["Sales", "Store", "Date"], 200)


@query("distinct_sorted", with_panel() + 'SELECT DISTINCT "StoreType" FROM panel ORDER BY 1')
def q_distinct_sorted(spark, sf):
    return D.distinct_sorted(store_panel(spark, sf), "StoreType")


# ---------------------------------------------------------------- G5 / G14 over all numeric columns
_NUM = ["DayOfWeek", "Sales", "Customers", "Promo", "SchoolHoliday", "CompetitionDistance", "Promo2"]
_LONG_SQL = "lg AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST("{c}" AS DOUBLE) AS x FROM o WHERE "{c}" IS NOT NULL""" for c in _NUM) + ")"


@query("hist_all_numeric", with_panel(OPEN, _LONG_SQL,
                                      'r AS (SELECT "column", min(x) AS lo, max(x) AS hi FROM lg GROUP BY 1)',
                                      """c AS (SELECT lg."column", CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((x - r.lo) * 10 / (r.hi - r.lo)), 9) END AS INTEGER) AS bin,
                                             count(*) AS n FROM lg JOIN r ON lg."column" = r."column" GROUP BY 1, 2)""",
                                      'g AS (SELECT r.*, CAST(unnest(range(0, 10)) AS INTEGER) AS bin FROM r)') + f"""
SELECT g."column", g.bin, {srnd('g.lo + g.bin * (g.hi - g.lo) / 10', 6)} AS bin_lo,
       {srnd('g.lo + (g.bin + 1) * (g.hi - g.lo) / 10', 6)} AS bin_hi, coalesce(c.n, 0) AS "count"
FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def q_hist_all_numeric(spark, sf):
    h = G.histogram_columns(_open(spark, sf), _NUM, 10)
    return h.select("column", "bin", rnd("bin_lo", 6).alias("bin_lo"), rnd("bin_hi", 6).alias("bin_hi"), "count")


@query("box_stats_columns", with_panel(OPEN, _LONG_SQL, """q AS (SELECT "column", quantile_cont(x, 0.25) AS q1,
        quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM lg GROUP BY 1)""",
                                       "f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)") + f"""
SELECT f."column", count(*) AS n, {srnd('f.q1')} AS q1, {srnd('f.med')} AS median, {srnd('f.q3')} AS q3,
       min(CASE WHEN lg.x >= lo_f AND lg.x <= hi_f THEN lg.x END) AS whisker_lo,
       max(CASE WHEN lg.x >= lo_f AND lg.x <= hi_f THEN lg.x END) AS whisker_hi,
       count(*) FILTER (WHERE NOT (lg.x >= lo_f AND lg.x <= hi_f)) AS n_outliers
FROM lg JOIN f ON lg."column" = f."column" GROUP BY f."column", f.q1, f.med, f.q3""")
def q_box_stats_columns(spark, sf):
    b = G.box_stats_columns(_open(spark, sf), _NUM)
    return b.select("column", "n", rnd("q1").alias("q1"), rnd("median").alias("median"), rnd("q3").alias("q3"),
                    "whisker_lo", "whisker_hi", "n_outliers")
