"""Scalar date functions, encoders and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import with_panel
from tillcast.functions import scalars as S
from tillcast.operators import encoders as E
from tillcast.operators import filters as B
from tillcast.operators import splits as V
from tillcast.sources.tables import store_panel

CUT = 'cut AS (SELECT CAST(max("Date") - INTERVAL 3 MONTH AS DATE) AS c FROM panel)'
TRAIN = 'tr AS (SELECT * FROM panel WHERE "Open" = 1 AND "Date" <= (SELECT c FROM cut))'
OPEN = 'o AS (SELECT * FROM panel WHERE "Open" = 1)'
PI = "3.141592653589793"


def _train_open(spark, sf):
    p = store_panel(spark, sf, materialize=True)
    train, _ = V.time_split(p, 3)
    return p, B.drop_closed(train, keep_flag=True)


_DATE_PARTS_SQL = """CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
       CAST(weekofyear("Date") AS INTEGER) AS "WeekOfYear", CAST(day("Date") AS INTEGER) AS "DayOfMonth",
       CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS "IsWeekend", CAST(quarter("Date") AS INTEGER) AS "Quarter" """


def _cyc_sql():
    return ", ".join([
        f"""{srnd(f'sin(2 * {PI} * month("Date") / 12.0)', 6)} AS "Month_sin" """,
        f"""{srnd(f'cos(2 * {PI} * month("Date") / 12.0)', 6)} AS "Month_cos" """,
        f"""{srnd(f'sin(2 * {PI} * weekofyear("Date") / 52.0)', 6)} AS "Week_sin" """,
        f"""{srnd(f'cos(2 * {PI} * weekofyear("Date") / 52.0)', 6)} AS "Week_cos" """])


_CYC = ("Month_sin", "Month_cos", "Week_sin", "Week_cos")


@query("date_parts", with_panel() + f"""
SELECT "Store", "Date", {_DATE_PARTS_SQL},
       CASE WHEN "DayOfWeek" IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend_dow" FROM panel""")
def q_date_parts(spark, sf):
    p = store_panel(spark, sf, materialize=True)
    d = F.col("Date")
    return p.select("Store", "Date", S.year(d).alias("Year"), S.month(d).alias("Month"),
                    S.iso_week(d).alias("WeekOfYear"), S.day_of_month(d).alias("DayOfMonth"),
                    S.is_weekend(d).alias("IsWeekend"), S.quarter(d).alias("Quarter"),
                    S.is_weekend_from_dow("DayOfWeek").alias("IsWeekend_dow"))


@query("cyclical", with_panel() + f'SELECT "Store", "Date", {_cyc_sql()} FROM panel')
def q_cyclical(spark, sf):
    p = store_panel(spark, sf).select("Store", "Date")
    ms, mc = S.cyclical(S.month("Date"), 12)
    ws, wc = S.cyclical(S.iso_week("Date"), 52)
    return p.select("Store", "Date", *[rnd(c, 6).alias(n) for c, n in zip((ms, mc, ws, wc), _CYC)])


@query("date_features", with_panel() + f'SELECT "Store", "Sales", {_DATE_PARTS_SQL}, {_cyc_sql()} FROM panel')
def q_date_features(spark, sf):
    p = E.date_features(store_panel(spark, sf, materialize=True).select("Store", "Date", "Sales"))
    return p.select("Store", "Sales", *[c for c in E.DATE_FEATURES if c not in _CYC], *[rnd(c, 6).alias(c) for c in _CYC])


@query("one_hot", with_panel() + """
SELECT "Store", "Date",
       CASE WHEN "StoreType" = 'b' THEN 1 ELSE 0 END AS "StoreType_b",
       CASE WHEN "StoreType" = 'c' THEN 1 ELSE 0 END AS "StoreType_c",
       CASE WHEN "StoreType" = 'd' THEN 1 ELSE 0 END AS "StoreType_d",
       CASE WHEN "Assortment" = 'extended' THEN 1 ELSE 0 END AS "Assortment_extended",
       CASE WHEN "Assortment" = 'extra' THEN 1 ELSE 0 END AS "Assortment_extra"
FROM panel""")
def q_one_hot(spark, sf):
    p, train = _train_open(spark, sf)
    enc = E.fit_one_hot(train, ["StoreType", "Assortment"])
    return enc.transform(p.select("Store", "Date", "StoreType", "Assortment"))


@query("one_hot_long", with_panel() + """
SELECT "Store", "Date", 'StoreType_' || "StoreType" AS feature FROM panel WHERE "StoreType" <> 'a'
UNION ALL SELECT "Store", "Date", 'Assortment_' || "Assortment" FROM panel WHERE "Assortment" <> 'basic'""")
def q_one_hot_long(spark, sf):
    """E2 in the form without a bound on the number of levels: one row per indicator that is set."""
    p, train = _train_open(spark, sf)
    return E.fit_one_hot_long(train, ["StoreType", "Assortment"]).transform(p, ["Store", "Date"])


_SCALE = ("Sales", "Customers", "CompetitionDistance")


@query("standard_scale", with_panel(CUT, TRAIN, OPEN, "s AS (SELECT " + ", ".join(
    f'avg("{c}") AS m_{c}, CASE WHEN stddev_pop("{c}") = 0 THEN 1.0 ELSE stddev_pop("{c}") END AS s_{c}'
    for c in _SCALE) + " FROM tr)") + 'SELECT "Store", "Date", ' + ", ".join(
    f'{srnd(f"(o.{chr(34)}{c}{chr(34)} - s.m_{c}) / s.s_{c}", 6)} AS "{c}"' for c in _SCALE) + " FROM o CROSS JOIN s")
def q_standard_scale(spark, sf):
    p, train = _train_open(spark, sf)
    sc = E.fit_scaler(train, _SCALE)
    out = sc.transform(B.drop_closed(p, keep_flag=True).select("Store", "Date", *_SCALE))
    return out.select("Store", "Date", *[rnd(c, 6).alias(c) for c in _SCALE])


@query("group_median_impute", with_panel(CUT, TRAIN, """gm AS (SELECT "StoreType", median("CompetitionDistance") AS m
        FROM tr GROUP BY 1)""") + f"""
SELECT p."Store", p."Date",
       {srnd('coalesce(p."CompetitionDistance", gm.m, (SELECT median("CompetitionDistance") FROM tr))')} AS "CompetitionDistance"
FROM panel p LEFT JOIN gm ON p."StoreType" = gm."StoreType" """)
def q_group_median_impute(spark, sf):
    p, train = _train_open(spark, sf)
    imp = E.fit_group_median(train, "CompetitionDistance", "StoreType")
    out = imp.transform(p.select("Store", "Date", "StoreType", "CompetitionDistance"))
    return out.select("Store", "Date", rnd("CompetitionDistance").alias("CompetitionDistance"))


def _te_sql(c):
    return f"""te_{c} AS (SELECT "{c}", (sum("Sales") + 10.0 * (SELECT avg("Sales") FROM tr)) / (count("Sales") + 10.0) AS enc
        FROM tr WHERE "{c}" IS NOT NULL GROUP BY 1)"""


@query("target_encode", with_panel(CUT, TRAIN, OPEN, _te_sql("StoreType"), _te_sql("Assortment")) + f"""
SELECT o."Store", o."Date",
       {srnd('coalesce(a.enc, (SELECT avg("Sales") FROM tr))')} AS "StoreType_encoded",
       {srnd('coalesce(b.enc, (SELECT avg("Sales") FROM tr))')} AS "Assortment_encoded"
FROM o LEFT JOIN te_StoreType a ON o."StoreType" = a."StoreType"
       LEFT JOIN te_Assortment b ON o."Assortment" = b."Assortment" """)
def q_target_encode(spark, sf):
    p, train = _train_open(spark, sf)
    enc = E.fit_target_encoder(train, ["StoreType", "Assortment"], target="Sales")
    out = enc.transform(B.drop_closed(p).select("Store", "Date", "StoreType", "Assortment"))
    return out.select("Store", "Date", rnd("StoreType_encoded").alias("StoreType_encoded"),
                      rnd("Assortment_encoded").alias("Assortment_encoded"))


def _fold_col():
    return F.pmod(F.unix_date("Date") * 31 + F.col("Store"), F.lit(5)).cast("int")


_FOLD_SQL = '(("Date" - DATE \'1970-01-01\') * 31 + "Store") % 5'


def _oof_sql(c):
    return f"""s_{c} AS (SELECT "{c}", fold, sum("Sales") AS s, count("Sales") AS n FROM trf WHERE "{c}" IS NOT NULL GROUP BY 1, 2),
    e_{c} AS (SELECT "{c}", fold, CASE WHEN sum(n) OVER (PARTITION BY "{c}") - n > 0
        THEN (sum(s) OVER (PARTITION BY "{c}") - s) / (sum(n) OVER (PARTITION BY "{c}") - n) END AS enc FROM s_{c})"""


@query("target_encode_oof", with_panel(CUT, TRAIN, f"trf AS (SELECT *, {_FOLD_SQL} AS fold FROM tr)",
                                       _oof_sql("StoreType"), _oof_sql("Assortment")) + f"""
SELECT t."Store", t."Date", t."StoreType", t."Assortment",
       {srnd('coalesce(a.enc, (SELECT avg("Sales") FROM trf))')} AS "StoreType_target_enc",
       {srnd('coalesce(b.enc, (SELECT avg("Sales") FROM trf))')} AS "Assortment_target_enc"
FROM trf t LEFT JOIN e_StoreType a ON t."StoreType" = a."StoreType" AND t.fold = a.fold
           LEFT JOIN e_Assortment b ON t."Assortment" = b."Assortment" AND t.fold = b.fold""")
def q_target_encode_oof(spark, sf):
    _, train = _train_open(spark, sf)
    out = E.target_encode_oof(train.select("Store", "Date", "StoreType", "Assortment", "Sales"),
                              ["StoreType", "Assortment"], target="Sales", fold=_fold_col())
    return out.select("Store", "Date", "StoreType", "Assortment",
                      rnd("StoreType_target_enc").alias("StoreType_target_enc"),
                      rnd("Assortment_target_enc").alias("Assortment_target_enc"))


_PRE_OUT = ["Store", "DayOfWeek", "Promo", "StateHoliday", "SchoolHoliday", "CompetitionDistance", "Promo2",
            "Year", "Month", "WeekOfYear", "DayOfMonth", "IsWeekend", "Quarter"]


@query("preprocess", with_panel(CUT, TRAIN, """gm AS (SELECT "StoreType", median("CompetitionDistance") AS m
        FROM tr GROUP BY 1)""", _te_sql("StoreType"), _te_sql("Assortment"), OPEN) + f"""
SELECT o."Store", o."DayOfWeek", o."Promo",
       CASE WHEN o."StateHoliday" IS NOT DISTINCT FROM '0' THEN 0 ELSE 1 END AS "StateHoliday",
       o."SchoolHoliday",
       {srnd('coalesce(o."CompetitionDistance", gm.m, (SELECT median("CompetitionDistance") FROM tr))')} AS "CompetitionDistance",
       o."Promo2", {_DATE_PARTS_SQL.replace('"Date"', 'o."Date"')}, {_cyc_sql().replace('"Date"', 'o."Date"')},
       {srnd('coalesce(a.enc, (SELECT avg("Sales") FROM tr))')} AS "StoreType_encoded",
       {srnd('coalesce(b.enc, (SELECT avg("Sales") FROM tr))')} AS "Assortment_encoded"
FROM o LEFT JOIN gm ON o."StoreType" = gm."StoreType"
       LEFT JOIN te_StoreType a ON o."StoreType" = a."StoreType"
       LEFT JOIN te_Assortment b ON o."Assortment" = b."Assortment" """)
def q_preprocess(spark, sf):
    p = store_panel(spark, sf, materialize=True)
    train, _ = V.time_split(p, 3)
    pre = E.fit_preprocessor(train)
    out = pre.transform(p.drop("Customers")).drop("Sales")
    return out.select(*[c for c in _PRE_OUT if c != "CompetitionDistance"],
                      rnd("CompetitionDistance").alias("CompetitionDistance"),
                      *[rnd(c, 6).alias(c) for c in _CYC],
                      rnd("StoreType_encoded").alias("StoreType_encoded"),
                      rnd("Assortment_encoded").alias("Assortment_encoded"))


@query("time_split", with_panel(CUT) + """
SELECT "Store", "Date", CASE WHEN "Date" <= (SELECT c FROM cut) THEN 'train' ELSE 'test' END AS split FROM panel""")
def q_time_split(spark, sf):
    return V.label_time_split(store_panel(spark, sf).select("Store", "Date"))


@query("positional_split", with_panel('i AS (SELECT "Store", "Date", row_number() OVER (ORDER BY "Store", "Date") - 1 AS idx, count(*) OVER () AS n FROM panel)') + """
SELECT "Store", "Date", CASE WHEN idx < floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM i""")
def q_positional_split(spark, sf):
    return V.positional_split(store_panel(spark, sf).select("Store", "Date"), 0.8)


@query("expanding_folds", with_panel('i AS (SELECT "Store", "Date", row_number() OVER (ORDER BY "Store", "Date") - 1 AS row_idx, count(*) OVER () AS n FROM panel)',
                                     "j AS (SELECT *, n // 6 AS t FROM i)") + """
SELECT "Store", "Date", row_idx,
       CASE WHEN t > 0 AND row_idx >= n - t * 5 THEN CAST((row_idx - (n - t * 5)) // t AS INTEGER) END AS test_fold FROM j""")
def q_expanding_folds(spark, sf):
    return V.expanding_folds(store_panel(spark, sf).select("Store", "Date"), 5)


@query("date_features_draft", with_panel() + """
SELECT "Store", "Date", CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
       CAST(day("Date") AS INTEGER) AS "Day", CAST(weekofyear("Date") AS INTEGER) AS "WeekOfYear",
       CASE WHEN "DayOfWeek" IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend" FROM panel""")
def q_date_features_draft(spark, sf):
    p = E.date_features_draft(store_panel(spark, sf).select("Store", "Date", "DayOfWeek"))
    return p.select("Store", "Date", "Year", "Month", "Day", "WeekOfYear", "IsWeekend")
