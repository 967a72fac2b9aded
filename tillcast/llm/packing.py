"""Texts as Zstandard-compressed bytes, for shuffles and written tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.wordhash import each_text


def packed(text: Column) -> Column:
    """Compressed UTF-8 bytes of a text; null stays null."""
    @F.arrow_udf(T.BinaryType())
    def pack(column: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3).compress
        return pa.array((None if t is None else press(t.encode("utf-8")) for t in each_text(column)), pa.binary())
    return pack(text)


def unpacker() -> Callable[[bytes | None], bytes]:
    """``unpack`` for many texts: they share a decompressor."""
    expand = zstandard.ZstdDecompressor().decompress
    return lambda data: expand(data) if data is not None else b""


def unpack(data: bytes | None) -> bytes:
    """The bytes again; empty for null."""
    return unpacker()(data)
