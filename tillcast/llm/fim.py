"""Fill-in-the-middle: texts cut in three at code point borders found in a compressed boundary set.

Method. The byte offsets at which the code points of a UTF-8 text begin (and
its end) form a set of integers, kept as a Roaring bitmap keeps one: the
offsets are split by their high bits into containers of 2^16, and each
container is the smallest of three kinds: a sorted array, a bitmap, or runs of
consecutive offsets (an ASCII stretch is one run). Cumulative cardinalities
over the containers tell which one holds the k-th border; a select inside it
(an index, a search over the bitmap's running popcounts, or a search over the
runs' running lengths) gives its offset. Both cuts come from two such selects,
and the pieces are byte slices: no text is decoded.

The cut points and the form come from the hex SHA-256 of ``seed`` and the row's
id, so a row is cut alike wherever it is computed.

Edge cases: null and empty texts have form plain and an empty output; a null
id is hashed as an empty one; a text that contains a sentinel stays plain; very
long texts take one container per 64 KiB; equal cut points give an empty
middle; repeated rows are cut alike; other columns are carried as they are; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import carried, fresh

SEED = "1"
SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_FROM = 90     # third hash group modulo 100: plain from here
SPM_BELOW = 20      # fourth hash group modulo 100: suffix first below this
ROWS_OUT = 512      # rows of an outgoing batch
BITS = 16           # offsets of a container: 2^16
ARRAY_MOST = 4096   # an array of more entries is larger than a bitmap


class _Array:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class _Bitmap:
    def __init__(self, member: np.ndarray):
        packed = np.zeros(1 << (BITS - 3), dtype=np.uint8)
        bits = np.packbits(member, bitorder="little")
        packed[:len(bits)] = bits
        self.words = packed.view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.upto, k, side="right"))
        word, left = int(self.words[w]), k - (int(self.upto[w - 1]) if w else 0)
        for _ in range(left):
            word &= word - 1  # clear the lowest bit
        return (w << 6) + (word & -word).bit_length() - 1


class _Runs:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts, self.upto = starts.astype(np.int64), np.cumsum(lengths, dtype=np.int64)

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.starts[r]) + k - (int(self.upto[r - 1]) if r else 0)


def container(member: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The smallest container of the set bits of ``member`` (up to 2^16 flags, one of them set)."""
    count = int(np.count_nonzero(member))
    if count == len(member):
        return _Runs(np.zeros(1), np.array([count]))
    low = np.flatnonzero(member)
    heads = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(heads) < min(2 * count, 1 << (BITS - 3)):
        return _Runs(low[heads], np.diff(heads, append=count))
    return _Array(low) if count <= ARRAY_MOST else _Bitmap(member)


class BoundarySet:
    """Byte offsets at which the code points of a UTF-8 text begin, and its end."""

    def __init__(self, data: np.ndarray):
        member = np.empty(len(data) + 1, dtype=bool)
        np.not_equal(data & 0xC0, 0x80, out=member[:-1])
        member[-1] = True
        self.high, self.held, counts = [], [], []
        for high in range((len(data) >> BITS) + 1):
            part = member[high << BITS:(high + 1) << BITS]
            if count := int(np.count_nonzero(part)):
                self.high.append(high)
                self.held.append(container(part))
                counts.append(count)
        self.upto = np.cumsum(counts, dtype=np.int64)

    def __len__(self) -> int:
        """Code points of the text."""
        return int(self.upto[-1]) - 1

    def select(self, k: int) -> int:
        """Byte offset of border ``k``: where code point k begins, or the end."""
        c = int(np.searchsorted(self.upto, k, side="right"))
        return (self.high[c] << BITS) + self.held[c].select(k - (int(self.upto[c - 1]) if c else 0))


def cut(text: bytes, h: tuple[int, int, int, int], marks: tuple[bytes, bytes, bytes]) -> tuple[int, str, int | None, int | None, bytes]:
    """(code points, form, prefix and middle code points, output) of one text and its four hash groups."""
    border = BoundarySet(np.frombuffer(text, dtype=np.uint8))
    n = len(border)
    if n == 0 or h[2] % 100 >= PLAIN_FROM or any(m in text for m in marks):
        return n, "plain", None, None, text
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = border.select(first), border.select(second)
    p, s, m = marks
    if h[3] % 100 < SPM_BELOW:
        return n, "spm", first, second - first, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", first, second - first, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Outputs can be taken apart again only if no sentinel can arise across the border of a sentinel and a text."""
    for s in sentinels:
        for t in sentinels:
            if not s or (s != t and t in s) or any(s[-k:] == t[:k] for k in range(1, min(len(s), len(t)))):
                raise ValueError(f"sentinels {s!r} and {t!r} overlap")
    return sentinels


def fill_in_middle(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: str = SEED,
                   sentinels: tuple[str, str, str] = SENTINELS, keep_text: bool = True, out: str = "fim") -> DataFrame:
    """``df`` plus a struct ``out`` (a column of that name is replaced): n (code points), form (plain, psm or
    spm), prefix_chars and middle_chars (null if plain) and output, the text with its sentinels.

    One pass without a shuffle; rows leave in small batches however large the incoming ones are."""
    marks = tuple(s.encode() for s in _checked(sentinels))
    own = carried(df.columns, out, *([] if keep_text else [text_col]))
    x = fresh("_fim", df.columns)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    groups = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    work = df.select(*own, F.array(*groups).alias(f"{x}_h"), F.col(f"`{text_col}`").alias(f"{x}_text"))
    names = work.columns
    plain = [f"c{i}" for i in range(len(names) - 1)]  # names without dots inside
    made = T.StructType([T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                         T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                         T.StructField("output", T.BinaryType())])
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), ROWS_OUT):
                part = batch.slice(a, ROWS_OUT)
                texts = part.column(len(names) - 1).cast(pa.large_binary()).fill_null(b"")
                rows = [cut(t.as_buffer().to_pybytes(), tuple(h), marks) for t, h in zip(texts, part.column(len(names) - 2).to_pylist())]
                cols = [pa.array(c, kind.field(i).type) for i, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.StructArray.from_arrays(cols, fields=list(kind))], names=plain)

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, work.schema.fields[:-2])] + [T.StructField(plain[-1], made)])
    done = work.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(transform, schema).toDF(*names[:-2], out)
    field = f"`{out}`"
    return done.withColumn(out, F.struct(*[F.col(f"{field}.{c}") for c in made.names[:-1]], F.col(f"{field}.output").cast("string").alias("output")))


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text again, from an output and its form."""
    part = F.split(output, "|".join(re.escape(s) for s in _checked(sentinels)), -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))
