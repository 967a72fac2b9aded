"""Request and batch-scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.catalog.registry import query, rnd, srnd
from tillcast.catalog.sqlbase import with_panel
from tillcast.functions import scalars as S
from tillcast.operators import scoring as P
from tillcast.plans.scoring import fit_scorer
from tillcast.session import cut_lineage
from tillcast.sources.requests import REQUESTS_SQL, requests_from_suppliers
from tillcast.sources.tables import read_table, store_panel

_DATE_OK = "(regexp_matches(date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$') AND try_strptime(date, '%Y-%m-%d') IS NOT NULL)"
_CHECKS = [
    ("store_id", "store_id >= 1"), ("date", _DATE_OK), ("day_of_week", "day_of_week BETWEEN 1 AND 7"),
    ("promo", "promo IN (0, 1)"), ("school_holiday", "school_holiday IN (0, 1)"),
    ("store_type", "store_type IN ('a', 'b', 'c', 'd')"),
    ("competition_distance", "(competition_distance IS NULL OR competition_distance >= 0)"), ("promo2", "promo2 IN (0, 1)"),
]
_FAILED = "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in _CHECKS) + "], lambda x: x IS NOT NULL)"
VALID = "valid AS (SELECT * FROM req WHERE " + " AND ".join(f"coalesce({c}, false)" for _, c in _CHECKS) + ")"


def _requests(spark, sf):
    return requests_from_suppliers(spark, sf)


@query("validate_requests", "WITH " + REQUESTS_SQL + f"""
SELECT request_id, array_to_string({_FAILED}, ',') AS errors, len({_FAILED}) = 0 AS valid FROM req""")
def q_validate_requests(spark, sf):
    return P.validate_requests(_requests(spark, sf)).select("request_id", "errors", "valid")


@query("req_project", "WITH " + REQUESTS_SQL + """
SELECT request_id, store_id AS "Store", CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS "Date", day_of_week AS "DayOfWeek",
       1 AS "Open", promo AS "Promo", state_holiday AS "StateHoliday", school_holiday AS "SchoolHoliday",
       store_type AS "StoreType", assortment AS "Assortment", competition_distance AS "CompetitionDistance", promo2 AS "Promo2"
FROM req""")
def q_req_project(spark, sf):
    return P.request_to_panel(_requests(spark, sf))


@query("unknown_store", with_panel(REQUESTS_SQL) + """
SELECT request_id, store_id FROM req WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p."Store" = req.store_id)""")
def q_unknown_store(spark, sf):
    return P.unknown_store(_requests(spark, sf), store_panel(spark, sf)).select("request_id", "store_id")


@query("req_history", with_panel(REQUESTS_SQL, VALID) + """
SELECT v.request_id, h.n_rows, h.hmin, h.hmax FROM valid v
JOIN (SELECT "Store", count(*) AS n_rows, min("Date") AS hmin, max("Date") AS hmax FROM panel GROUP BY 1) h
  ON v.store_id = h."Store" """)
def q_req_history(spark, sf):
    """J2 re-aimed: each request joined with its store's history summary
    (history aggregated per store first, so the join is one row per request)."""
    req = P.validate_requests(_requests(spark, sf)).where("valid")
    h = store_panel(spark, sf).groupBy("Store").agg(F.count(F.lit(1)).alias("n_rows"), F.min("Date").alias("hmin"),
                                                    F.max("Date").alias("hmax"))
    return req.join(h, req.store_id == h.Store).select("request_id", "n_rows", "hmin", "hmax")


@query("latest_row", with_panel() + """
SELECT * FROM panel QUALIFY row_number() OVER (PARTITION BY "Store" ORDER BY "Date" DESC) = 1""")
def q_latest_row(spark, sf):
    return P.latest_row(store_panel(spark, sf))


@query("dup_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dup_keys(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return P.dup_keys(li, ("l_orderkey", "l_linenumber"))


_FRAMES = [
    REQUESTS_SQL, VALID,
    """rp AS (SELECT request_id, store_id AS "Store", CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS "Date",
        promo AS "Promo", school_holiday AS "SchoolHoliday" FROM valid)""",
    """hs AS (SELECT "Store", min("Date") AS hmin, max("Date") AS hmax FROM panel GROUP BY 1)""",
    """tl AS (SELECT "Store", avg("Sales") AS proxy FROM (SELECT "Store", "Sales",
        row_number() OVER (PARTITION BY "Store" ORDER BY "Date" DESC) AS rk FROM panel) WHERE rk <= 30 GROUP BY 1)""",
    """kn AS (SELECT rp.*, hs.hmin, hs.hmax, tl.proxy FROM rp JOIN hs ON rp."Store" = hs."Store"
        LEFT JOIN tl ON rp."Store" = tl."Store")""",
    """fr AS (SELECT DISTINCT "Store", "Date" AS d, CAST(CASE WHEN "Date" < hmin THEN 90 WHEN "Date" <= hmax THEN "Date" - hmin
        ELSE least("Date" - hmin, 90) END AS INTEGER) AS m, proxy FROM kn)""",
    """lb AS (SELECT fr.*, r.j, CAST(fr.d - r.j AS DATE) AS t FROM fr
        JOIN (SELECT CAST(range AS INTEGER) AS j FROM range(1, 31)) r ON r.j <= fr.m)""",
    """lv AS (SELECT lb.*, p."Sales" IS NOT NULL AS is_history,
        coalesce(p."Sales", lb.proxy, (SELECT median("Sales") FROM panel)) AS v
        FROM lb LEFT JOIN panel p ON p."Store" = lb."Store" AND p."Date" = lb.t)""",
]


@query("calendar_spine", with_panel(*_FRAMES) + f"""
SELECT kn.request_id, kn."Store", lv.t AS "Date", lv.j, {srnd('lv.v')} AS v, lv.is_history
FROM kn JOIN lv ON kn."Store" = lv."Store" AND kn."Date" = lv.d""")
def q_calendar_spine(spark, sf):
    rp = P.request_to_panel(P.validate_requests(_requests(spark, sf)).where("valid"))
    sp = P.calendar_spine(rp, store_panel(spark, sf, materialize=True))
    return sp.select("request_id", "Store", "Date", "j", rnd("v").alias("v"), "is_history")


_WIN = ["lag_7", "lag_14", "lag_30", "rolling_mean_7", "rolling_std_7", "rolling_mean_30", "rolling_std_30",
        "trend_slope_30d", "sales_momentum"]


@query("scoring_frame", with_panel(*_FRAMES, """fa AS (SELECT "Store", d, m,
        max(CASE WHEN j = 7 THEN v END) AS lag_7, max(CASE WHEN j = 14 THEN v END) AS lag_14,
        max(CASE WHEN j = 30 THEN v END) AS lag_30,
        avg(CASE WHEN j <= 7 THEN v END) AS rolling_mean_7, avg(CASE WHEN j <= 30 THEN v END) AS rolling_mean_30,
        stddev_samp(CASE WHEN j <= 7 THEN v END) AS rs7, stddev_samp(CASE WHEN j <= 30 THEN v END) AS rs30,
        regr_slope(v, CAST(-j AS DOUBLE)) AS sl FROM lv GROUP BY 1, 2, 3)""",
                                        """ff AS (SELECT fr."Store", fr.d, fr.m, fa.lag_7, fa.lag_14, fa.lag_30, fa.rolling_mean_7,
        fa.rolling_mean_30, coalesce(fa.rs7, 0) AS rolling_std_7, coalesce(fa.rs30, 0) AS rolling_std_30,
        CASE WHEN fr.m >= 30 THEN coalesce(fa.sl, 0) ELSE 0 END AS trend_slope_30d
        FROM fr LEFT JOIN fa ON fr."Store" = fa."Store" AND fr.d = fa.d AND fr.m = fa.m)""") + f"""
SELECT kn.request_id, kn."Store", kn."Date", {", ".join(f"{srnd('ff.' + c)} AS {c}" for c in _WIN[:-1])},
       {srnd('ff.rolling_mean_7 - ff.lag_7')} AS sales_momentum, kn."Promo" * kn."SchoolHoliday" AS "Promo_x_SchoolHoliday"
FROM kn JOIN ff ON kn."Store" = ff."Store" AND kn."Date" = ff.d""")
def q_scoring_frame(spark, sf):
    rp = P.request_to_panel(P.validate_requests(_requests(spark, sf)).where("valid"))
    f = P.request_window_features(rp, store_panel(spark, sf, materialize=True))
    return f.select("request_id", "Store", "Date", *[rnd(c).alias(c) for c in _WIN], "Promo_x_SchoolHoliday")


@query("batch_score")
def q_batch_score(spark, sf):
    """Every request of the table scored in one plan."""
    sc = fit_scorer(store_panel(spark, sf, materialize=True), n_boot=30)
    return sc.score(_requests(spark, sf))


def _x_cte(alias: str = "tr", name: str = "x", extra: str = "") -> str:
    """Model-input projection (29 features before the median fill) of the rows of ``alias``,
    with the preprocessing fitted on ``tr``."""
    pi = "3.141592653589793"
    sql = f"""x AS (SELECT {extra}tr."Store", tr."DayOfWeek", tr."Promo",
            CASE WHEN tr."StateHoliday" IS NOT DISTINCT FROM '0' THEN 0 ELSE 1 END AS "StateHoliday", tr."SchoolHoliday",
            coalesce(tr."CompetitionDistance", gm.m, (SELECT median("CompetitionDistance") FROM tr)) AS "CompetitionDistance",
            tr."Promo2", lag_7, lag_14, lag_30, rolling_mean_7, rolling_std_7, rolling_mean_30, rolling_std_30, trend_slope_30d,
            tr."Promo" * tr."SchoolHoliday" AS "Promo_x_SchoolHoliday", rolling_mean_7 - lag_7 AS sales_momentum,
            year(tr."Date") AS "Year", month(tr."Date") AS "Month", weekofyear(tr."Date") AS "WeekOfYear",
            day(tr."Date") AS "DayOfMonth", CASE WHEN isodow(tr."Date") >= 6 THEN 1 ELSE 0 END AS "IsWeekend",
            quarter(tr."Date") AS "Quarter",
            (round(sin(2 * {pi} * month(tr."Date") / 12.0), 12) + 0.0) AS "Month_sin", (round(cos(2 * {pi} * month(tr."Date") / 12.0), 12) + 0.0) AS "Month_cos",
            (round(sin(2 * {pi} * weekofyear(tr."Date") / 52.0), 12) + 0.0) AS "Week_sin", (round(cos(2 * {pi} * weekofyear(tr."Date") / 52.0), 12) + 0.0) AS "Week_cos",
            coalesce(a.enc, (SELECT avg("Sales") FROM tr)) AS "StoreType_encoded",
            coalesce(b.enc, (SELECT avg("Sales") FROM tr)) AS "Assortment_encoded"
        FROM tr LEFT JOIN gm ON tr."StoreType" = gm."StoreType"
        LEFT JOIN te_StoreType a ON tr."StoreType" = a."StoreType" LEFT JOIN te_Assortment b ON tr."Assortment" = b."Assortment")"""
    sql = sql.replace('FROM tr LEFT JOIN gm', f'FROM {alias} LEFT JOIN gm').replace('tr."', f'{alias}."')
    return f"{name}{sql[1:]}"


def _train_ctes() -> list[str]:
    """CTEs of the training flow in SQL: features, cutoff, training rows, fitted
    imputer/encoders, the 29-input projection ``x`` and its medians ``med``."""
    from tillcast.catalog.sqlbase import rows, w
    from tillcast.plans.training import FEATURES
    pi = "3.141592653589793"
    feat = f"""f AS (SELECT *, lag("Sales", 7) OVER {w()} AS lag_7, lag("Sales", 14) OVER {w()} AS lag_14,
        lag("Sales", 30) OVER {w()} AS lag_30,
        avg("Sales") OVER {w(rows(-7, -1))} AS rolling_mean_7, coalesce(stddev_samp("Sales") OVER {w(rows(-7, -1))}, 0) AS rolling_std_7,
        avg("Sales") OVER {w(rows(-30, -1))} AS rolling_mean_30, coalesce(stddev_samp("Sales") OVER {w(rows(-30, -1))}, 0) AS rolling_std_30,
        CASE WHEN count("Sales") OVER {w(rows(-30, -1))} = 30
             THEN coalesce(regr_slope("Sales", rn) OVER {w(rows(-30, -1))}, 0) ELSE 0 END AS trend_slope_30d
      FROM (SELECT *, CAST(row_number() OVER {w()} AS DOUBLE) AS rn FROM panel))"""
    cut = 'cut AS (SELECT CAST(max("Date") - INTERVAL 3 MONTH AS DATE) AS c FROM panel)'
    tr = 'tr AS (SELECT * FROM f WHERE "Open" = 1 AND "Date" <= (SELECT c FROM cut))'
    gm = 'gm AS (SELECT "StoreType", median("CompetitionDistance") AS m FROM tr GROUP BY 1)'

    def te(c):
        return f"""te_{c} AS (SELECT "{c}", (sum("Sales") + 10.0 * (SELECT avg("Sales") FROM tr)) / (count("Sales") + 10.0) AS enc
            FROM tr WHERE "{c}" IS NOT NULL GROUP BY 1)"""
    x = _x_cte()
    med = "med AS (SELECT " + ", ".join(f'median(CAST("{c}" AS DOUBLE)) AS "{c}"' for c in FEATURES) + " FROM x)"
    return [feat, cut, tr, gm, te("StoreType"), te("Assortment"), x, med]


def _fallback_sql():
    from tillcast.plans.training import FEATURES
    unk = 'unk AS (SELECT * FROM valid WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p."Store" = valid.store_id))'
    cols = ", ".join(f'{srnd(f"coalesce(med.{chr(34)}{c}{chr(34)}, 0.0)", 6)} AS "{c}"' for c in FEATURES)
    return with_panel(*_train_ctes(), REQUESTS_SQL, VALID, unk) + f"""
SELECT unk.request_id, {cols}, true AS used_fallback FROM unk CROSS JOIN med"""


@query("scoring_fallback", _fallback_sql())
def q_scoring_fallback(spark, sf):
    """P5: unknown-store requests scored on the training-median vector."""
    from tillcast.plans.training import FEATURES, model_frames
    md = model_frames(store_panel(spark, sf, materialize=True))
    valid = P.validate_requests(_requests(spark, sf)).where("valid")
    fb = P.fallback_rows(P.unknown_store(valid, store_panel(spark, sf)), md.medians, FEATURES)
    return fb.select("request_id", *[rnd(c, 6).alias(c) for c in FEATURES], "used_fallback")


def _features_sql():
    from tillcast.plans.training import FEATURES
    base = _fallback_sql()
    head = base[:base.index("\nSELECT unk.request_id")]
    pi = "3.141592653589793"
    rp = """rq AS (SELECT request_id, store_id AS "Store", CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS "Date",
        day_of_week AS "DayOfWeek", promo AS "Promo", state_holiday AS "StateHoliday", school_holiday AS "SchoolHoliday",
        store_type AS "StoreType", assortment AS "Assortment", competition_distance AS "CompetitionDistance",
        promo2 AS "Promo2", store_id, date AS req_date FROM valid)"""
    frames = [c.replace("FROM rp JOIN hs ON rp.", "FROM rq rp JOIN hs ON rp.") for c in _FRAMES[3:]]
    fa = """fa AS (SELECT "Store", d, m, max(CASE WHEN j = 7 THEN v END) AS lag_7, max(CASE WHEN j = 14 THEN v END) AS lag_14,
        max(CASE WHEN j = 30 THEN v END) AS lag_30, avg(CASE WHEN j <= 7 THEN v END) AS rolling_mean_7,
        avg(CASE WHEN j <= 30 THEN v END) AS rolling_mean_30, stddev_samp(CASE WHEN j <= 7 THEN v END) AS rs7,
        stddev_samp(CASE WHEN j <= 30 THEN v END) AS rs30, regr_slope(v, CAST(-j AS DOUBLE)) AS sl FROM lv GROUP BY 1, 2, 3)"""
    ff = """ff AS (SELECT fr."Store", fr.d, fa.lag_7, fa.lag_14, fa.lag_30, fa.rolling_mean_7, fa.rolling_mean_30,
        coalesce(fa.rs7, 0) AS rolling_std_7, coalesce(fa.rs30, 0) AS rolling_std_30,
        CASE WHEN fr.m >= 30 THEN coalesce(fa.sl, 0) ELSE 0 END AS trend_slope_30d
        FROM fr LEFT JOIN fa ON fr."Store" = fa."Store" AND fr.d = fa.d AND fr.m = fa.m)"""
    lt = """lt AS (SELECT "Store", "CompetitionDistance" AS lcd FROM panel
        QUALIFY row_number() OVER (PARTITION BY "Store" ORDER BY "Date" DESC) = 1)"""
    kx = f"""kx AS (SELECT kn.request_id, kn.store_id, kn.req_date, kn."Store", kn."DayOfWeek", kn."Promo",
        CASE WHEN kn."StateHoliday" IS NOT DISTINCT FROM '0' THEN 0 ELSE 1 END AS "StateHoliday", kn."SchoolHoliday",
        coalesce(kn."CompetitionDistance", lt.lcd, gm.m, (SELECT median("CompetitionDistance") FROM tr)) AS "CompetitionDistance",
        kn."Promo2", ff.lag_7, ff.lag_14, ff.lag_30, ff.rolling_mean_7, ff.rolling_std_7, ff.rolling_mean_30, ff.rolling_std_30,
        ff.trend_slope_30d, kn."Promo" * kn."SchoolHoliday" AS "Promo_x_SchoolHoliday",
        ff.rolling_mean_7 - ff.lag_7 AS sales_momentum,
        year(kn."Date") AS "Year", month(kn."Date") AS "Month", weekofyear(kn."Date") AS "WeekOfYear",
        day(kn."Date") AS "DayOfMonth", CASE WHEN isodow(kn."Date") >= 6 THEN 1 ELSE 0 END AS "IsWeekend",
        quarter(kn."Date") AS "Quarter",
        (round(sin(2 * {pi} * month(kn."Date") / 12.0), 12) + 0.0) AS "Month_sin", (round(cos(2 * {pi} * month(kn."Date") / 12.0), 12) + 0.0) AS "Month_cos",
        (round(sin(2 * {pi} * weekofyear(kn."Date") / 52.0), 12) + 0.0) AS "Week_sin", (round(cos(2 * {pi} * weekofyear(kn."Date") / 52.0), 12) + 0.0) AS "Week_cos",
        coalesce(a.enc, (SELECT avg("Sales") FROM tr)) AS "StoreType_encoded",
        coalesce(b.enc, (SELECT avg("Sales") FROM tr)) AS "Assortment_encoded"
        FROM kn JOIN ff ON kn."Store" = ff."Store" AND kn."Date" = ff.d
        LEFT JOIN lt ON kn."Store" = lt."Store" LEFT JOIN gm ON kn."StoreType" = gm."StoreType"
        LEFT JOIN te_StoreType a ON kn."StoreType" = a."StoreType" LEFT JOIN te_Assortment b ON kn."Assortment" = b."Assortment")"""
    known = ", ".join(f'{srnd(f"coalesce(CAST(kx.{chr(34)}{c}{chr(34)} AS DOUBLE), med.{chr(34)}{c}{chr(34)})", 4)} AS "{c}"'
                      for c in FEATURES)
    fallback = ", ".join(f'{srnd(f"coalesce(med.{chr(34)}{c}{chr(34)}, 0.0)", 4)} AS "{c}"' for c in FEATURES)
    return (head + ",\n" + ",\n".join([rp, *frames, fa, ff, lt, kx]) + f"""
SELECT kx.request_id, {known}, false AS used_fallback, kx.store_id, kx.req_date AS date FROM kx CROSS JOIN med
UNION ALL
SELECT unk.request_id, {fallback}, true AS used_fallback, unk.store_id, unk.date FROM unk CROSS JOIN med""")


@query("scoring_features", _features_sql())
def q_scoring_features(spark, sf):
    """P4 + P5: the 29 model inputs per valid request (unknown stores: training medians)."""
    from tillcast.plans.scoring import request_features
    from tillcast.plans.training import FEATURES, model_frames
    hist = store_panel(spark, sf, materialize=True)
    x = request_features(_requests(spark, sf), hist, model_frames(hist))
    return x.select("request_id", *[rnd(c, 4).alias(c) for c in FEATURES], "used_fallback", "store_id", "date")



def _psi_inputs_sql():
    from tillcast.catalog.drift_q import _psi_sql
    from tillcast.plans.training import FEATURES
    oa = 'oa AS (SELECT * FROM f WHERE "Open" = 1)'
    xa = _x_cte("oa", "xa", extra="""CASE WHEN tr."Date" <= (SELECT c FROM cut) THEN 'ref' ELSE 'cur' END AS side, """)
    xf = ("xf AS (SELECT side, " + ", ".join(f'coalesce(CAST(xa."{c}" AS DOUBLE), med."{c}") AS "{c}"' for c in FEATURES)
          + " FROM xa CROSS JOIN med)")
    return _psi_sql([*_train_ctes(), oa, xa, xf], "xf", "side", FEATURES)


@query("psi_model_inputs", _psi_inputs_sql())
def q_psi_model_inputs(spark, sf):
    """M2 as the monitoring flow uses it: PSI of every model input, filled
    training matrix vs filled test matrix."""
    from tillcast.operators import drift as M
    from tillcast.plans.training import FEATURES, model_frames
    md = model_frames(store_panel(spark, sf, materialize=True))
    equal = {c: S.canonical(c) for c in ("Month_sin", "Month_cos", "Week_sin", "Week_cos")}  # as on the other engine
    r = M.psi_report(cut_lineage(md.train.withColumns(equal)), cut_lineage(md.test.withColumns(equal)), FEATURES)
    return r.select("feature", rnd("PSI", 6).alias("PSI"), "status")
