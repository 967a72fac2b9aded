"""Table sources: the driver's parquet tables and the store-day panel.

The panel (entity x date x measures) is the core data model. Natively it
comes from a CSV/parquet file with a fixed schema (``read_panel``); for the
test tables it is derived from orders x customer x nation
(``store_panel``), one row per (nation, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed panel schema (no inference: a file of only '0' holidays must not
# turn StateHoliday into an integer).
PANEL_SCHEMA = T.StructType([
    T.StructField("Store", T.IntegerType()),
    T.StructField("Date", T.DateType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Sales", T.DoubleType()),
    T.StructField("Customers", T.DoubleType()),
    T.StructField("Open", T.IntegerType()),
    T.StructField("Promo", T.IntegerType()),
    T.StructField("StateHoliday", T.StringType()),
    T.StructField("SchoolHoliday", T.IntegerType()),
    T.StructField("StoreType", T.StringType()),
    T.StructField("Assortment", T.StringType()),
    T.StructField("CompetitionDistance", T.DoubleType()),
    T.StructField("Promo2", T.IntegerType()),
])

PANEL_COLUMNS = [f.name for f in PANEL_SCHEMA.fields]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one driver table; selecting columns here keeps the scan pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_panel(spark: SparkSession, path: str, fmt: str = "csv", mode: str = "FAILFAST") -> DataFrame:
    """Load a native panel file with the fixed schema.

    CSV is read with a header and the fixed schema; ``mode`` is the Spark
    parse mode (FAILFAST rejects malformed rows, PERMISSIVE nulls them).
    Parquet input is cast to the same schema.
    """
    if fmt == "csv":
        df = (spark.read.schema(PANEL_SCHEMA).option("header", True)
              .option("mode", mode).option("dateFormat", "yyyy-MM-dd").csv(path))
    else:
        raw = spark.read.format(fmt).load(path)
        df = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PANEL_SCHEMA.fields])
    # NaN is not NULL in Spark; the reference treats both as missing.
    return df.select(*[
        F.when(F.isnan(F.col(f.name)), None).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in PANEL_SCHEMA.fields
    ])


def _state_holiday(d: Column) -> Column:
    # Fixed values of the derived panel: 'a' on 1 January, 'c' on 25/26 December.
    return (F.when((F.month(d) == 1) & (F.dayofmonth(d) == 1), F.lit("a"))
            .when((F.month(d) == 12) & F.dayofmonth(d).isin(25, 26), F.lit("c"))
            .otherwise(F.lit("0")))


def store_panel(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Store-day panel derived from the driver tables.

    By default the panel is a plan: filters and column pruning of its
    consumer reach the raw scans. With ``materialize`` it is written once to
    the checkpoint folder, for jobs whose many branches (cutoffs, fits, joins,
    scalar statistics) would otherwise re-join the raw tables.

    Plan shape: orders (4 columns) join customer (2 columns) on the customer
    key (sort-merge at scale, AQE splits hot customers), then one aggregate
    on (nation, day) with map-side partial aggregation, so a hot nation is
    combined before the shuffle. The distinct-customer count is planned by
    Spark as a two-level aggregate keyed by (nation, day, customer). The
    nation dimension is joined after aggregation; the planner broadcasts
    it from its file-size statistics (autoBroadcastJoinThreshold).
    """
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])

    daily = (orders.join(customer, orders.o_custkey == customer.c_custkey)
             .groupBy(F.col("c_nationkey"), F.to_date("o_orderdate").alias("Date"))
             .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("_sales"),
                  F.count_distinct("o_custkey").cast("double").alias("Customers"),
                  F.max((F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("Promo")))

    d = F.col("Date")
    closed = F.weekday(d) == 6  # Sunday
    k = F.col("c_nationkey")
    panel = (daily.join(nation, daily.c_nationkey == nation.n_nationkey)
            .select(
                (k + 1).cast("int").alias("Store"),
                d,
                (F.weekday(d) + 1).cast("int").alias("DayOfWeek"),
                F.when(closed, F.lit(0.0)).otherwise(F.col("_sales")).alias("Sales"),
                F.col("Customers"),
                F.when(closed, 0).otherwise(1).cast("int").alias("Open"),
                F.col("Promo").cast("int").alias("Promo"),
                _state_holiday(d).alias("StateHoliday"),
                F.month(d).isin(7, 8).cast("int").alias("SchoolHoliday"),
                F.element_at(F.array(*[F.lit(x) for x in ("a", "b", "c", "d", "a")]),
                             F.col("n_regionkey") + 1).alias("StoreType"),
                F.element_at(F.array(*[F.lit(x) for x in ("basic", "extra", "extended")]),
                             F.pmod(k, F.lit(3)) + 1).alias("Assortment"),
                F.when(F.pmod(k, F.lit(7)) == 3, F.lit(None).cast("double"))
                 .otherwise(((k + 1) * 100).cast("double")).alias("CompetitionDistance"),
                F.pmod(k, F.lit(2)).cast("int").alias("Promo2"),
            ))
    if materialize:
        from tillcast.session import cut_lineage
        panel = cut_lineage(panel)
    return panel
