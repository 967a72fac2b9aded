"""Size-checked broadcast.

A side is broadcast only after its row count has been checked against a
bound. Past the bound the plain DataFrame is returned and Spark plans a
shuffle join, so correctness never depends on the data being small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast up to this many bytes, counted as rows times row width.
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
# Bytes counted for a field by its kind.
_FIELD, _TEXT, _NESTED = 16, 96, 1024


def row_width(df: DataFrame) -> int:
    """Bytes counted for a row of ``df``, from its schema (texts and nested values at a generous size)."""
    def width(t: T.DataType) -> int:
        if isinstance(t, T.StructType):
            return sum(width(f.dataType) for f in t.fields)
        if isinstance(t, (T.ArrayType, T.MapType)):
            return _NESTED
        return _TEXT if isinstance(t, (T.StringType, T.BinaryType)) else _FIELD
    return 32 + sum(width(f.dataType) for f in df.schema.fields)


def broadcast_checked(df: DataFrame, known_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` iff it is provably small; otherwise leave the join to a shuffle.

    The bound is on rows times row width. ``known_rows`` is a number of rows
    the caller can prove from how ``df`` was built (one row per feature of a
    fixed list); else ``limit(bound + 1).count()`` counts them, which stops
    reading as soon as the bound is exceeded.
    """
    most = max(1, max_bytes // row_width(df))
    rows = known_rows if known_rows is not None else df.limit(most + 1).count()
    return F.broadcast(df) if rows <= most else df
