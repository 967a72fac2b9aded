"""Shared DuckDB SQL fragments for the oracle.

``PANEL`` is the store-day panel over orders x customer x nation, the same
definition ``tillcast.sources.tables.store_panel`` builds in Spark.
"""

PANEL = """panel AS (
  SELECT CAST(a.nk + 1 AS INTEGER) AS "Store",
         a.d AS "Date",
         CAST(isodow(a.d) AS INTEGER) AS "DayOfWeek",
         CASE WHEN isodow(a.d) = 7 THEN 0.0 ELSE a.sales END AS "Sales",
         a.customers AS "Customers",
         CASE WHEN isodow(a.d) = 7 THEN 0 ELSE 1 END AS "Open",
         a.promo AS "Promo",
         CASE WHEN month(a.d) = 1 AND day(a.d) = 1 THEN 'a'
              WHEN month(a.d) = 12 AND day(a.d) IN (25, 26) THEN 'c' ELSE '0' END AS "StateHoliday",
         CASE WHEN month(a.d) IN (7, 8) THEN 1 ELSE 0 END AS "SchoolHoliday",
         (['a', 'b', 'c', 'd', 'a'])[n.n_regionkey + 1] AS "StoreType",
         (['basic', 'extra', 'extended'])[a.nk % 3 + 1] AS "Assortment",
         CASE WHEN a.nk % 7 = 3 THEN CAST(NULL AS DOUBLE) ELSE CAST(100 * (a.nk + 1) AS DOUBLE) END AS "CompetitionDistance",
         CAST(a.nk % 2 AS INTEGER) AS "Promo2"
  FROM (SELECT c.c_nationkey AS nk, CAST(o.o_orderdate AS DATE) AS d,
               CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sales,
               CAST(COUNT(DISTINCT o.o_custkey) AS DOUBLE) AS customers,
               CAST(MAX(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS INTEGER) AS promo
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        GROUP BY c.c_nationkey, CAST(o.o_orderdate AS DATE)) a
  JOIN nation n ON a.nk = n.n_nationkey
)"""


def with_panel(*ctes: str) -> str:
    """``WITH panel AS (...), <ctes>`` prefix."""
    parts = [PANEL, *ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def w(frame: str = "") -> str:
    """Window clause over the panel order, with an optional frame."""
    return f'(PARTITION BY "Store" ORDER BY "Date" {frame})'


def rows(lo: int, hi: int) -> str:
    def b(x):
        if x < 0:
            return f"{-x} PRECEDING"
        if x == 0:
            return "CURRENT ROW"
        return f"{x} FOLLOWING"
    return f"ROWS BETWEEN {b(lo)} AND {b(hi)}"
