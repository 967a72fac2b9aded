"""Scoring-request sources.

A request batch is ``{"requests": [{store_id, date, ...}, ...]}``;
``read_request_batch`` reads such JSON files and explodes them into one
row per request. ``requests_from_suppliers`` derives a request table from
the driver's ``supplier`` table by a fixed rule, so request volume grows
with the data (including some malformed and unknown-store requests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.sources.tables import read_table

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("store_id", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("promo", T.IntegerType()),
    T.StructField("state_holiday", T.StringType()),
    T.StructField("school_holiday", T.IntegerType()),
    T.StructField("store_type", T.StringType()),
    T.StructField("assortment", T.StringType()),
    T.StructField("competition_distance", T.DoubleType()),
    T.StructField("promo2", T.IntegerType()),
])

# Defaults of the optional request fields.
REQUEST_DEFAULTS = {"state_holiday": "0", "school_holiday": 0, "store_type": "a", "assortment": "basic", "promo2": 0}


def with_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in REQUEST_DEFAULTS.items()})


def read_request_batch(spark: SparkSession, path: str) -> DataFrame:
    """Read batch JSON documents (one object per file, multi-line allowed) and explode the requests."""
    batch = T.StructType([T.StructField("requests", T.ArrayType(REQUEST_SCHEMA))])
    raw = spark.read.schema(batch).option("multiLine", True).json(path)
    return with_defaults(raw.select(F.inline("requests")))


def requests_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per supplier (rule-based, deterministic)."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    d = F.when(k % 29 == 0, F.lit("1994-10-01").cast("date")).otherwise(
        F.date_add(F.lit("2001-07-01").cast("date"), (k % 60).cast("int")))
    return s.select(
        k.alias("request_id"),
        F.when(k % 10 == 0, n + 101).otherwise(n + 1).cast("int").alias("store_id"),
        F.when(k % 17 == 0, F.date_format(d, "yyyy/MM/dd")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("date"),
        F.when(k % 31 == 0, F.lit(0)).otherwise(F.weekday(d) + 1).cast("int").alias("day_of_week"),
        F.when(k % 23 == 0, F.lit(2)).otherwise(k % 2).cast("int").alias("promo"),
        F.lit("0").alias("state_holiday"),
        F.month(d).isin(7, 8).cast("int").alias("school_holiday"),
        F.when(k % 37 == 0, F.lit("e")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (n % 4 + 1).cast("int"))).alias("store_type"),
        F.element_at(F.array(*[F.lit(x) for x in ("basic", "extra", "extended")]), (n % 3 + 1).cast("int")).alias("assortment"),
        F.when(k % 6 == 0, F.lit(None).cast("double")).when(k % 41 == 0, F.lit(-1.0))
         .otherwise(F.abs(F.col("s_acctbal"))).alias("competition_distance"),
        (n % 2).cast("int").alias("promo2"),
    )


REQUESTS_SQL = """req AS (
  SELECT s_suppkey AS request_id,
         CAST(CASE WHEN s_suppkey % 10 = 0 THEN s_nationkey + 101 ELSE s_nationkey + 1 END AS INTEGER) AS store_id,
         CASE WHEN s_suppkey % 17 = 0 THEN strftime(d, '%Y/%m/%d') ELSE strftime(d, '%Y-%m-%d') END AS date,
         CAST(CASE WHEN s_suppkey % 31 = 0 THEN 0 ELSE isodow(d) END AS INTEGER) AS day_of_week,
         CAST(CASE WHEN s_suppkey % 23 = 0 THEN 2 ELSE s_suppkey % 2 END AS INTEGER) AS promo,
         '0' AS state_holiday,
         CASE WHEN month(d) IN (7, 8) THEN 1 ELSE 0 END AS school_holiday,
         CASE WHEN s_suppkey % 37 = 0 THEN 'e' ELSE (['a', 'b', 'c', 'd'])[s_nationkey % 4 + 1] END AS store_type,
         (['basic', 'extra', 'extended'])[s_nationkey % 3 + 1] AS assortment,
         CASE WHEN s_suppkey % 6 = 0 THEN CAST(NULL AS DOUBLE) WHEN s_suppkey % 41 = 0 THEN -1.0 ELSE abs(s_acctbal) END AS competition_distance,
         CAST(s_nationkey % 2 AS INTEGER) AS promo2
  FROM (SELECT *, CASE WHEN s_suppkey % 29 = 0 THEN DATE '1994-10-01'
                       ELSE CAST(DATE '2001-07-01' + CAST(s_suppkey % 60 AS INTEGER) AS DATE) END AS d FROM supplier) s
)"""
