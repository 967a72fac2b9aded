"""Benchmark decontamination: a broadcast hash set of normalised item n-grams.

Words are A-Z lower-cased runs of ASCII letters and digits and non-ASCII
characters. A window is ``n`` consecutive words of an item; an item of fewer
words, but not none, is one window. The windows' hashes are broadcast as a
sorted array; each task hashes every window of its texts from word hashes
(numpy over the batch's bytes), looks them up, compares the words of each hit
with the item's, and marks the words covered.

The broadcast is bounded: at most ``block_windows`` windows at a time. A larger
benchmark is cut into blocks of whole items by a hash of the item text, the
documents are scanned once per block, and the marks of a document are united.

Edge cases: null and empty texts have no words and no hits; repeated items and
items with the same text all count as hit; an item with a null id marks words
and is left out of the item list; an empty benchmark hits nothing; an empty
table gives an empty result; other columns are carried and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import carried, fresh, materialize
from tillcast.llm.wordhash import owner, text_slices, window_hashes, word_bounds, word_hashes

NGRAM = 13
BLOCK_WINDOWS = 1_000_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MARKS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.IntegerType())),  # hit runs of words: first word,
    T.StructField("ends", T.ArrayType(T.IntegerType())),    # and the word after the last
    T.StructField("begin", T.ArrayType(T.IntegerType())),   # the same runs as byte ranges of the text
    T.StructField("finish", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.IntegerType())),   # numbers of the items hit
])


def words(text: Column) -> Column:
    """Normalised words of a text (JVM side); null gives an empty array."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(f"({WORD})"), F.lit(1))


class WindowSet:
    """The windows of some items, ready for lookup in tasks."""

    def __init__(self, items: list[list[str]], n: int = NGRAM):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.texts: dict[tuple[bytes, ...], list[int]] = {}
        for k, w in enumerate(items):
            size = min(n, len(w))
            for i in range(len(w) - size + 1 if size else 0):
                owners = self.texts.setdefault(tuple(x.encode("utf-8") for x in w[i:i + size]), [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        keys = sorted(self.texts, key=len)
        for size in {len(k) for k in keys}:
            rows = [k for k in keys if len(k) == size]
            flat = b" ".join(x for k in rows for x in k)
            data = np.frombuffer(flat, dtype=np.uint8)
            low, s, e, _ = word_bounds(data, np.array([0, len(data)]))
            hashes = window_hashes(word_hashes(low, s, e), size)[::size]
            hashes = np.sort(hashes)
            bits = max(16, int(np.ceil(np.log2(len(hashes) * 32))))
            table = np.zeros(1 << bits, dtype=bool)
            table[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.by_length[size] = hashes, table

    def find(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Positions whose hash is that of a window of ``size`` words."""
        known, table = self.by_length[size]
        shift = np.uint64(64 - (len(table).bit_length() - 1))
        at = np.flatnonzero(table[(hashes >> shift).astype(np.int64)])
        slot = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
        return at[known[slot] == hashes[at]]


def _marks(data: np.ndarray, offsets: np.ndarray, windows: WindowSet) -> dict[str, list]:
    low, starts, ends, first = word_bounds(data, offsets)
    n = len(starts)
    hashes, doc = word_hashes(low, starts, ends), owner(first)
    delta = np.zeros(n + 1, dtype=np.int32)
    items: dict[int, set[int]] = {}
    raw = low.tobytes()
    for size in windows.by_length:
        if n < size:
            continue
        at = windows.find(window_hashes(hashes, size), size)
        at = at[doc[at] == doc[at + size - 1]]
        for i in at.tolist():
            found = windows.texts.get(tuple(raw[a:b] for a, b in zip(starts[i:i + size].tolist(), ends[i:i + size].tolist())))
            if found:  # the words themselves agree, not only their hash
                delta[i] += 1
                delta[i + size] -= 1
                items.setdefault(int(doc[i]), set()).update(found)
    hit = np.zeros(n + 2, dtype=np.int8)
    hit[1:n + 1] = np.cumsum(delta[:n]) > 0
    if items:  # runs stop at a text's end
        split = np.zeros(n + 1, dtype=bool)
        split[first] = True
        open_ = np.flatnonzero((hit[1:n + 1] == 1) & ((hit[:n] == 0) | split[:n]))
        close = np.flatnonzero((hit[1:n + 1] == 1) & ((hit[2:n + 2] == 0) | split[1:n + 1])) + 1
    else:
        open_ = close = np.zeros(0, dtype=np.int64)
    cut = np.searchsorted(open_, first)
    out: dict[str, list] = {f.name: [] for f in MARKS.fields}
    out["n_words"] = np.diff(first).tolist()
    for k in range(len(first) - 1):
        o, c = open_[cut[k]:cut[k + 1]], close[cut[k]:cut[k + 1]]
        out["starts"].append(o - first[k])
        out["ends"].append(c - first[k])
        out["begin"].append(starts[o] - offsets[k])
        out["finish"].append(ends[c - 1] - offsets[k])
        out["items"].append(sorted(items.get(k, ())))
    return out


def mark_column(text: Column, windows) -> Column:
    """Hit words of a text as a struct (``MARKS``); ``windows`` is a broadcast WindowSet."""
    @F.arrow_udf(MARKS)
    def marks(column: pa.Array) -> pa.Array:
        fields = list(MARKS.fields)
        parts: dict[str, list] = {f.name: [] for f in fields}
        for data, offsets in text_slices(column):
            for k, v in _marks(data, offsets, windows.value).items():
                parts[k].extend(v)
        return pa.StructArray.from_arrays(
            [pa.array(parts["n_words"], pa.int64())] + [pa.array(parts[f.name], pa.list_(pa.int32())) for f in fields[1:]],
            names=[f.name for f in fields])
    return marks(text)


def item_blocks(bench: DataFrame, text_col: str, id_col: str, n: int, block_windows: int) -> Iterator[list]:
    """(id, words) of the items, in blocks of at most ``block_windows`` windows."""
    listed = bench.select(F.col(f"`{id_col}`").cast("string").alias("id"), words(F.col(f"`{text_col}`")).alias("w"))
    listed = listed.filter(F.size("w") > 0).distinct()
    total = listed.agg(F.sum(F.greatest(F.size("w") - n + 1, F.lit(1)))).first()[0] or 0
    blocks = 1 if total <= block_windows else -(-2 * total // block_windows)
    for b in range(blocks):
        part = listed if blocks == 1 else listed.filter(F.pmod(F.xxhash64("w"), F.lit(blocks)) == b)
        yield [(r["id"], list(r["w"])) for r in part.collect()]


def find_contamination(docs: DataFrame, bench: DataFrame, text_col: str = "text", bench_text: str = "text",
                       bench_id: str = "item_id", n: int = NGRAM, block_windows: int = BLOCK_WINDOWS,
                       share: int = 20, out: str = "contamination") -> DataFrame:
    """``docs`` plus a struct ``out`` (a column of that name is replaced): n_words, n_hit, items (distinct item ids hit, as
    sorted strings), spans (hit byte ranges of the UTF-8 text), and contaminated:
    n_hit > 0 and share * n_hit >= n_words."""
    spark = docs.sparkSession
    text, mark = F.col(f"`{text_col}`"), fresh("_marks", docs.columns)
    own = carried(docs.columns, out)
    parts = []
    blocks = [rows for rows in item_blocks(bench, bench_text, bench_id, n, block_windows) if rows] or [[]]
    rest = blocks[1:]
    base = docs if not rest else materialize(docs, "decontaminate-documents").withColumn(f"{mark}uid", F.monotonically_increasing_id())
    for rows in blocks:
        windows = spark.sparkContext.broadcast(WindowSet([w for _, w in rows], n))
        names = F.array(*[F.lit(i).cast("string") for i, _ in rows]) if rows else F.array().cast("array<string>")
        marked = base.withColumn(mark, mark_column(text, windows))
        picked = F.array_sort(F.array_distinct(F.array_compact(F.transform(f"{mark}.items", lambda i: F.get(names, i)))))
        runs = F.arrays_zip(F.col(f"{mark}.starts").alias("from"), F.col(f"{mark}.ends").alias("to"),
                            F.col(f"{mark}.begin").alias("begin"), F.col(f"{mark}.finish").alias("end"))
        parts.append(marked.withColumn(mark, F.struct(F.col(f"{mark}.n_words").alias("n_words"), picked.alias("items"), runs.alias("runs"))))
    if not rest:
        found = parts[0]
    else:  # unite the blocks: one row per document again, by the row number fixed in the written table
        every = parts[0].select(f"{mark}uid", mark)
        for p in parts[1:]:
            every = every.unionByName(p.select(f"{mark}uid", mark).filter(F.size(f"{mark}.runs") > 0))
        one = every.groupBy(f"{mark}uid").agg(F.struct(
            F.max(f"{mark}.n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{mark}.items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list(f"{mark}.runs"))).alias("runs")).alias(mark))
        found = base.join(one, f"{mark}uid")
    merged = _union_runs(F.col(f"{mark}.runs")) if rest else F.col(f"{mark}.runs")
    found = found.withColumn(mark, F.struct(F.col(f"{mark}.n_words").alias("n_words"), F.col(f"{mark}.items").alias("items"), merged.alias("runs")))
    n_hit = F.aggregate(f"{mark}.runs", F.lit(0).cast("long"), lambda s, r: s + (r["to"] - r["from"]))
    return found.select(*own, F.struct(
        F.col(f"{mark}.n_words").alias("n_words"), n_hit.alias("n_hit"), F.col(f"{mark}.items").alias("items"),
        F.transform(f"{mark}.runs", lambda r: F.struct(r["begin"].alias("begin"), r["end"].alias("end"))).alias("spans"),
        ((n_hit > 0) & (share * n_hit >= F.col(f"{mark}.n_words"))).alias("contaminated")).alias(out))


def _union_runs(runs: Column) -> Column:
    """Unite overlapping or touching runs of a sorted array."""
    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["from"].alias("from"), F.greatest(last["to"], r["to"]).alias("to"),
                          last["begin"].alias("begin"), F.greatest(last["end"], r["end"]).alias("end"))
        return (F.when(F.size(done) == 0, F.array(r))
                .when(r["from"] <= last["to"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
                .otherwise(F.concat(done, F.array(r))))
    return F.aggregate(runs, F.slice(runs, 1, 0), step)


def remove_spans(found: DataFrame, text_col: str = "text", out: str = "contamination") -> DataFrame:
    """The text without its hit spans (the words and what stands between them)."""
    @F.arrow_udf(T.StringType())
    def cut(column: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(column.to_pylist(), spans.to_pylist()):
            if t is not None and s:
                raw, kept, at = t.encode("utf-8", "surrogatepass"), [], 0
                for x in s:
                    kept.append(raw[at:x["begin"]])
                    at = x["end"]
                t = b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")
            out.append(t)
        return pa.array(out, pa.string())
    return found.withColumn(text_col, cut(F.col(f"`{text_col}`"), F.col(f"{out}.spans")))


def remove_documents(found: DataFrame, out: str = "contamination") -> DataFrame:
    """The rows that are not contaminated, without the report column."""
    return found.filter(~F.col(f"{out}.contaminated")).drop(out)
