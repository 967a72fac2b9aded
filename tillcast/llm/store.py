"""Column names and intermediate tables of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize, small_batches, temporary_tables  # noqa: F401  (the operators take them from here)


def fresh(name: str, taken: list[str]) -> str:
    """``name`` with underscores added until no taken column starts with it (column names ignore case)."""
    while any(c.lower().startswith(name.lower()) for c in taken):
        name += "_"
    return name


def least_by_hash(df: DataFrame, order: str, max_rows: int) -> DataFrame:
    """The ``max_rows`` rows of the least ``order`` (a uniform 64-bit hash; other columns break ties).

    The rows are counted, and a bound on the hash that leaves about one and a
    half times ``max_rows`` of them goes before the sort, so what is sorted and
    sent to one task does not grow with the table or its partitions."""
    n = df.count()
    if n > 2 * max_rows:
        df = df.filter(F.col(order) < int(-(1 << 63) + (1 << 64) * (1.5 * max_rows / n)))
    return df.orderBy(order, *[c for c in df.columns if c != order]).limit(max_rows)


def carried(columns: list[str], *replaced: str) -> list[Column]:
    """The columns that an operator passes on: all but those it replaces."""
    gone = {c.lower() for c in replaced}
    return [F.col(f"`{c}`") for c in columns if c.lower() not in gone]
