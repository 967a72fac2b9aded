"""Registry of named queries and their DuckDB oracle SQL.

Every query is ``(spark, sf_dir) -> DataFrame`` and reads the driver's
tables (or data Spark derives from them), so its work grows with them.
The oracle SQL, when given, computes the same columns over the same
parquet views in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Display rounding shared by both engines. Spark rounds the decimal string
# half-up, DuckDB rounds the binary value, so exact .5 ties would split;
# a nudge far below the kept precision and far above floating noise sends
# ties the same way in both.
def rnd(c, k: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(10.0 ** -(k + 5)), k)


def srnd(expr: str, k: int = 2) -> str:
    return f"round(({expr}) + {10.0 ** -(k + 5):.0e}, {k})"
