"""Exact removal of long repeated byte strings with suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else, in the same text or another; matches never cross texts.

Sharding. Suffixes that may share ``length`` bytes are brought together by
content: of all ``gram``-byte strings inside a window of ``length`` bytes the least
hash is the window's key, so equal windows have equal keys wherever they
stand. Consecutive windows of one key form a run, and the run with the bytes its
windows cover is its context. Keys that occur once are settled, unless the least
string occurs twice in the run, which may then repeat itself. Contexts that occur
more than once as a whole (equal digest) are repeated in full, and need no
sorting. What is left, the distinct contexts of keys with several of them, is
dealt to shards by key, and each shard is sorted.

Two-stage suffix sorting per shard. A suffix is of type B if it is smaller than
its successor, else of type A. Only type B suffixes are sorted directly (eight
bytes a round, ties only). One scan over the buckets of first bytes then
induces the order of all type A suffixes. Neighbours in the suffix array with a
common prefix of ``length`` bytes are the repeats.

Hot keys. A key with more than ``hot_contexts`` distinct contexts (the edge of a
passage that very many texts hold) is not sent to one shard: its windows are
counted by a 128-bit hash of their bytes, with partial sums before the
shuffle. Both ways find the same windows.

Edge cases: null and empty texts, and texts below ``length`` bytes, have nothing to
remove; repeated rows repeat each other in full; null ids make no difference;
an empty table gives an empty result; other columns are carried. ``docs`` must be
a repeatable read (such as a table), since rows are numbered by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.packing import packed, unpack
from tillcast.llm.store import carried, fresh, materialize, temporary_tables
from tillcast.llm.wordhash import mix, range_hasher, text_slices

LENGTH = 200
GRAM = 64
SHARD_BYTES = 4 << 20
HOT_CONTEXTS = 4096
_SLICE = 1 << 19


# -- suffix array of one shard ------------------------------------------------

def _words8(text: np.ndarray) -> np.ndarray:
    """The eight symbols from each position as one number, in symbol order (zeros past the end)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(text)]
    return out


def _window_hashes(keys: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` symbols from each position (zeros past the end), by doubling from eight symbols."""
    def ahead(x: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([x[by:], np.zeros(min(by, len(x)), np.uint64)])

    out, done, power, width = np.zeros(len(keys), np.uint64), 0, keys.copy(), 8
    while True:
        if (length // 8) & (width // 8):  # a part of this width belongs to the window
            out = mix(out * np.uint64(0xD1342543DE82EF95) + ahead(power, done) + np.uint64(width))
            done += width
        if done + 8 > length:
            break
        power = mix(power * np.uint64(0x9E3779B97F4A7C15) + ahead(power, width))
        width *= 2
    return mix(out + ahead(keys, length - 8)) if length % 8 else out


def _direct_sort(rows: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """Suffixes ``rows`` sorted by their first ``length`` symbols.

    Suffixes that agree in all of them stand together by a hash, and one of each kind is sorted: by eight symbols,
    then eight more a round among those that tie, five symbols to a round where the tie's number leaves no more room."""
    n = len(keys)
    kind = _window_hashes(keys, length)[rows]
    by = np.argsort(kind, kind="stable")
    head = np.ones(len(rows), dtype=bool)
    head[1:] = kind[by[1:]] != kind[by[:-1]]
    first = np.flatnonzero(head)
    one = rows[by[first]]  # the first suffix of every kind
    place = np.argsort(keys[one])
    group = np.zeros(len(one), dtype=np.int64)
    if len(one):
        group[1:] = np.cumsum(keys[one[place[1:]]] != keys[one[place[:-1]]])
    todo = np.arange(len(one))
    for depth in range(8, length, 5):
        if len(todo):
            tied = np.zeros(len(todo), dtype=bool)
            same = group[todo[1:]] == group[todo[:-1]]
            tied[1:] |= same
            tied[:-1] |= same
            todo = todo[tied]
        if not len(todo):
            break
        base = group[todo]
        number = np.cumsum(np.concatenate([[0], base[1:] != base[:-1]])).astype(np.uint64)  # below 2^24: ties come in pairs
        at = one[place[todo]] + depth
        key = (number << np.uint64(40)) | (np.where(at < n, keys[np.minimum(at, n - 1)], np.uint64(0)) >> np.uint64(24))
        by_key = np.argsort(key)
        place[todo], key = place[todo[by_key]], key[by_key]
        new = np.ones(len(todo), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        # numbers that keep the old groups apart and number the parts inside them
        group[todo] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
    size = np.diff(np.append(first, len(rows)))[place]
    begin = np.cumsum(size) - size
    return rows[by[np.arange(len(rows)) + np.repeat(first[place] - begin, size)]]


def suffix_array(text: np.ndarray, length: int, room: np.ndarray | None = None) -> np.ndarray:
    """Two-stage suffix array of symbols 0..255 (0 separates and ends), in order by the first ``length`` symbols.

    With ``room`` (symbols up to the next separator) only suffixes of ``length`` symbols or more are sure to be there:
    a shorter type B suffix is sorted only if the run of type A before it reaches back to one of them."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    # type B: smaller than the successor. Runs of one symbol take the type of what follows them.
    rising = np.zeros(n, dtype=np.int8)
    rising[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    rising[-1] = -1
    known = np.where(rising != 0, np.arange(n), n)
    following = np.minimum.accumulate(known[::-1])[::-1]
    type_b = rising[np.minimum(following, n - 1)] > 0
    keys = _words8(text)
    ends = np.zeros(n, dtype=bool)
    ends[-1] = True  # the last symbol has no successor: sorted directly too
    type_a = ~(type_b | ends)
    wanted = ~type_a
    if room is not None:
        start = np.maximum.accumulate(np.where(type_a, 0, np.arange(n) + 1))  # where the run of type A up to a position begins
        before = np.zeros(n, dtype=np.int64)
        before[1:] = np.arange(1, n) - start[:-1]
        wanted &= room + before >= length
    direct = _direct_sort(np.flatnonzero(wanted), keys, length)
    cut = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def deal(found: np.ndarray) -> None:
        """Put the type A predecessors of ``found`` behind what their buckets hold, in order."""
        before = found[found > 0] - 1
        before = before[type_a[before]]
        symbol = text[before]
        for c in np.unique(symbol):
            induced[c].append(before[symbol == c])

    out = []
    for c in range(256):
        k = 0
        while k < len(induced[c]):  # what a run of one symbol induces comes back to its own bucket
            deal(induced[c][k])
            k += 1
        out += induced[c]
        ordered = direct[cut[c]:cut[c + 1]]
        if len(ordered):
            deal(ordered)
            out.append(ordered)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context the positions whose ``length`` bytes also start elsewhere in the shard."""
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.zeros(begin[-1], dtype=np.uint8)  # a separator, smaller than any byte, after each context
    room = np.zeros(len(text), dtype=np.int64)
    for b, s, c in zip(begin, size, contexts):
        text[b:b + s] = np.frombuffer(c, dtype=np.uint8) + np.uint8(1)  # UTF-8 has no byte above 0xF7
        room[b:b + s] = np.arange(s, 0, -1)
    order = suffix_array(text, length, room)
    order = order[room[order] >= length]  # what stood between two equal strings is equal to them as well
    keys = _words8(text)
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for depth in range(0, length, 8):  # common prefix of neighbours, up to ``length``
        at = min(depth, length - 8)
        same = same[keys[a[same] + at] == keys[b[same] + at]]
    flag = np.zeros(len(text) + 1, dtype=bool)
    flag[a[same]] = flag[b[same]] = True
    return [np.flatnonzero(flag[x:x + s]) for x, s in zip(begin[:-1], size)]


# -- runs of windows with one key -----------------------------------------------

def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive entries."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (n - width)], x[n - width:]) if n > width else x


def _runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text index, first window, last window, key, digest, again) of every run; positions
    count from the text's start. ``again``: the key's gram occurs more than once in the
    run, so that the run may repeat itself."""
    n = len(data) - length + 1
    empty = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool)
    at = np.arange(len(data) - gram + 1)
    bytes_hash = range_hasher(data)
    grams = bytes_hash(at, at + gram)
    least = _sliding_min(grams, length - gram + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = doc[:n] == doc[length - 1:]  # windows that stay in one text
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1] | (doc[1:n] != doc[:n - 1])
    first = np.flatnonzero(new & inside)
    stop = np.ones(n, dtype=bool)
    stop[:-1] = new[1:] | ~inside[1:]
    last = np.flatnonzero(stop & inside)
    digest = mix(bytes_hash(first, last + length) ^ mix(range_hasher(mix(grams))(first, last + length - gram + 1)))
    again = np.zeros(len(first), dtype=bool)
    if len(first):
        size = last - first + length - gram + 1  # grams of each run
        begin = np.cumsum(size) - size
        at = np.arange(begin[-1] + size[-1]) - np.repeat(begin - first, size)
        again = np.add.reduceat(grams[at] == np.repeat(least[first], size), begin, dtype=np.int64) > 1
    return doc[first], first - offsets[doc[first]], last - offsets[doc[first]], least[first], digest, again


def run_rows(docs: DataFrame, uid: str, text: str, length: int, gram: int) -> DataFrame:
    """(uid, first, last, key, digest, again) of the runs of every text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, at = batch.column(0).to_numpy(), 0
            for data, offsets in text_slices(batch.column(1), _SLICE):
                doc, first, last, key, digest, again = _runs(data, offsets, length, gram)
                yield pa.RecordBatch.from_arrays([
                    pa.array(uids[at + doc]), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(again)], ["uid", "first", "last", "key", "digest", "again"])
                at += len(offsets) - 1
    return docs.select(uid, text).mapInArrow(scan, "uid long, first int, last int, key long, digest long, again boolean")


def context_rows(docs: DataFrame, wanted: DataFrame, uid: str, text: str, length: int) -> DataFrame:
    """(uid, first, key, n, context bytes) of the wanted runs (uid, first, last, key, n)."""
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("first", "last", "key", "n")).alias("runs"))  # the runs of one text
    texts = docs.select(F.col(uid).alias("uid"), packed(F.col(text)).alias("packed"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["uid", "first", "key", "n", "context"])

        rows, size = [], 0
        for batch in batches:
            for u, p, runs in zip(batch.column("uid").to_pylist(), batch.column("packed").to_pylist(), batch.column("runs").to_pylist()):
                raw = unpack(p)
                for r in runs:
                    rows.append((u, r["first"], r["key"], r["n"], raw[r["first"]:r["last"] + length]))
                    size += len(rows[-1][4])
                if size > _SLICE:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)

    return texts.join(lists, "uid").mapInArrow(scan, "uid long, first int, key long, n long, context binary")


def shard_spans(contexts: DataFrame, shards: int, length: int, shard_bytes: int) -> DataFrame:
    """(uid, begin, end): repeated spans of the contexts that occur once, from the suffix arrays of the shards."""
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("key", "uid", "first", "n", "context")))]
        rows.sort(key=lambda r: r[0])
        a = 0
        while a < len(rows):  # whole keys, about shard_bytes at a time
            b, size = a, 0
            while b < len(rows) and (size < shard_bytes or rows[b][0] == rows[b - 1][0]):
                size += len(rows[b][4])
                b += 1
            uids, begin, end = [], [], []
            for (_, uid, first, n, _), hit in zip(rows[a:b], repeated_starts([r[4] for r in rows[a:b]], length)):
                if n == 1 and len(hit):
                    breaks = np.flatnonzero(np.diff(hit) > 1) + 1
                    for run in np.split(hit, breaks):
                        uids.append(uid)
                        begin.append(first + int(run[0]))
                        end.append(first + int(run[-1]) + length)
            yield pa.RecordBatch.from_arrays([pa.array(uids, pa.int64()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
                                             ["uid", "begin", "end"])
            a = b
    return contexts.repartition(shards, "key").mapInArrow(sort, "uid long, begin int, end int")


def hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for keys of very many contexts: windows counted by a 128-bit hash."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0  # contexts of the batch so far
        for batch in batches:
            # all contexts of the batch as one run of bytes; windows inside one context only
            for data, offsets in text_slices(batch.column("context"), _SLICE):
                at = np.arange(max(0, len(data) - length + 1))
                whose = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                at = at[whose[at] == whose[at + length - 1]] if len(at) else at
                row = done + whose[at] if len(at) else at
                h1, h2 = range_hasher(data)(at, at + length), range_hasher(mix(data.astype(np.uint64) + np.uint64(7)))(at, at + length)
                begin = batch.column("first").to_numpy()[row] + at - offsets[row - done]
                yield pa.RecordBatch.from_arrays([
                    pa.array(batch.column("uid").to_numpy()[row]), pa.array(begin.astype(np.int32)), pa.array(batch.column("n").to_numpy()[row]),
                    pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["uid", "begin", "n", "h1", "h2"])
                done += len(offsets) - 1
            done = 0

    rows = contexts.mapInArrow(windows, "uid long, begin int, n long, h1 long, h2 long")
    often = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return (rows.filter("n = 1").join(often, ["h1", "h2"])
            .select("uid", "begin", (F.col("begin") + length).cast("int").alias("end")))


def repeated_spans(docs: DataFrame, uid: str, text_col: str, length: int = LENGTH, gram: int = GRAM,
                   shard_bytes: int = SHARD_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """(uid, spans): the byte ranges of each text to remove (they may overlap)."""
    runs = run_rows(docs, uid, f"`{text_col}`", length, gram)
    often = runs.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("again").alias("again")).filter("m > 1 OR again").select("key")
    met = materialize(runs.join(often, "key"), "suffix-runs")
    kinds = materialize(met.groupBy("key", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"),
                                                        F.min(F.struct("uid", "first", "last")).alias("one")), "suffix-contexts")
    mixed = (kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"), F.max("again").alias("again"))
             .filter("(kinds > 1 OR again) AND least = 1").select("key", "kinds"))
    wanted = kinds.join(mixed, "key").select("one.uid", "one.first", "one.last", "key", "n", "kinds")
    size = wanted.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0] or 0
    contexts = materialize(context_rows(docs, wanted.select("uid", "first", "last", "key", "n"), uid, f"`{text_col}`", length)
                           .join(mixed, "key"), "suffix-bytes")
    shards = max(1, -(-size // shard_bytes))
    spans = shard_spans(contexts.filter(F.col("kinds") <= hot_contexts).drop("kinds"), shards, length, shard_bytes)
    spans = spans.unionByName(hot_spans(contexts.filter(F.col("kinds") > hot_contexts).drop("kinds"), length))
    whole = (met.join(kinds.filter("n > 1").select("key", "digest"), ["key", "digest"])
             .select("uid", F.col("first").alias("begin"), (F.col("last") + length).cast("int").alias("end")))
    return whole.unionByName(spans).groupBy("uid").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


KEPT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
                     T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())])


def _cut_column(texts: Column, spans: Column) -> Column:
    @F.arrow_udf(KEPT)
    def cut(packed_: pa.Array, spans_: pa.Array) -> pa.Array:
        kept, size, removed, runs = [], [], [], []
        for p, s in zip(packed_, spans_):
            raw = unpack(p.as_py())
            parts, at, gone, n = [], 0, 0, 0
            if s.is_valid and len(s.values):
                begin, end = s.values.field("begin").to_numpy(), s.values.field("end").to_numpy()
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(end[order])
                new = np.concatenate([[True], begin[1:] > reach[:-1]])
                starts = begin[new]
                ends = reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]
                for b, e in zip(starts.tolist(), ends.tolist()):
                    parts.append(raw[at:b])
                    gone += e - b
                    at = e
                n = len(starts)
            kept.append(b"".join([*parts, raw[at:]]) if n else raw)
            size.append(len(raw))
            removed.append(gone)
            runs.append(n)
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, removed, runs))],
                                          names=[f.name for f in KEPT.fields])
    return cut(texts, spans)


def remove_repeats(docs: DataFrame, text_col: str = "text", out: str = "unique", **options) -> DataFrame:
    """``docs`` without the text, plus a struct ``out`` (a column of that name is replaced): kept (the remaining bytes), n_bytes, n_removed,
    n_spans (maximal removed runs)."""
    uid = fresh("_suffix", docs.columns)
    numbered = docs.withColumn(uid, F.monotonically_increasing_id())
    with temporary_tables(docs.sparkSession):
        spans = materialize(repeated_spans(numbered, uid, text_col, **options), "suffix-spans", keep=True).select(F.col("uid").alias(f"{uid}r"), F.col("spans").alias(f"{uid}s"))
    own = carried(docs.columns, out, text_col)
    texts = numbered.select(*own, uid, packed(F.col(f"`{text_col}`")).alias(f"{uid}p"))
    joined = texts.join(spans, F.col(uid) == F.col(f"{uid}r"), "left")
    return joined.select(*own, _cut_column(F.col(f"{uid}p"), F.col(f"{uid}s")).alias(out))
