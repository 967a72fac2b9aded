"""Exact cumulative counts and quantiles without single-task groups.

Spark's exact ``percentile`` keeps a value->count map per group and merges
it in one task, so a group with very many distinct values (a feature of a
100 TB table) would land in one task. Here the work is spread instead:

1. collapse to one row per (group, value) with counts (map-side combine);
2. cut each group's value range into ``buckets`` slices at approximate
   quantile points (``percentile_approx``: bounded sketch per group) --
   the slices only steer partitioning, the result stays exact;
3. prefix-sum the slice totals (groups x buckets rows) to get each
   slice's offset;
4. running sums inside each (group, slice) partition, plus the offset,
   give the exact inclusive cumulative count of every distinct value.

Exact quantiles then pick, for each requested rank, the distinct value
whose cumulative range covers it -- a filter over the cumulative table,
no join of ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.sizing import broadcast_checked


# Upper bound on distinct values sorted together in one (group, slice) window partition.
ROWS_PER_SLICE = 2_000_000


def auto_buckets(counts: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> int:
    """Slices needed so that no slice of a group exceeds ``rows_per_slice``
    distinct values (all groups counted together, a safe upper bound).
    The rows are counted: pass a materialized table."""
    return max(1, math.ceil(counts.count() / rows_per_slice))


def cumulative_counts(counts: DataFrame, group: str, value: str, count_cols, buckets: int | None = None,
                      sketch_accuracy: int = 10_000, n_groups: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive cumulative sum in value order within group) for each count column.

    ``counts`` must hold one row per (group, value). ``n_groups`` is a known
    bound on the number of groups (skips the broadcast size checks).
    ``buckets=None`` sizes the slicing from the row count of ``counts``
    (pass a materialized table: the count then reads it once).
    """
    count_cols = list(count_cols)
    if buckets is None:
        buckets = auto_buckets(counts)
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        splits = counts.groupBy(group).agg(F.percentile_approx(value, probs, sketch_accuracy).alias("__sp"))
        b = (counts.join(broadcast_checked(splits, known_rows=n_groups), group)
             .withColumn("__b", F.size(F.filter("__sp", lambda s: s < F.col(value)))).drop("__sp"))
    else:
        b = counts.withColumn("__b", F.lit(0))
    tot = b.groupBy(group, "__b").agg(*[F.sum(c).alias(c) for c in count_cols])
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(group, "__b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__off_{c}")
                                     for c in count_cols])  # groups x buckets rows
    run = Window.partitionBy(group, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    if buckets > 1:
        out = b.join(broadcast_checked(off, known_rows=None if n_groups is None else n_groups * buckets), [group, "__b"])
    else:
        out = b.withColumns({f"__off_{c}": F.lit(0) for c in count_cols})
    out = out.withColumns({f"cum_{c}": F.col(f"__off_{c}") + F.sum(c).over(run) for c in count_cols})
    return out.drop("__b", *[f"__off_{c}" for c in count_cols])


def exact_quantiles(df: DataFrame, group: str, value: str, probs, buckets: int | None = 64,
                    n_groups: int | None = None) -> DataFrame:
    """(group, pi, p, q): exact linearly interpolated quantiles of ``value`` per group.

    Position p*(n-1) over the sorted non-null values; the result is
    lo + (hi - lo) * frac, as numpy's default and SQL ``percentile_cont``.
    """
    vals = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("__c"))
    if buckets is None:
        from tillcast.session import cut_lineage
        vals = cut_lineage(vals)  # read by the slicing count and by several branches
    return quantiles_from_counts(vals, group, value, "__c", probs, buckets, n_groups)


def quantiles_from_counts(vals: DataFrame, group: str, value: str, count_col: str, probs, buckets: int | None = None,
                          n_groups: int | None = None) -> DataFrame:
    """Exact quantiles from a (group, value, count) table (one row per distinct value, count > 0)."""
    probs = [float(p) for p in probs]
    vals = vals.select(group, value, F.col(count_col).alias("__c")).where(F.col("__c") > 0)
    if buckets is None:
        buckets = auto_buckets(vals)
    if buckets <= 1:
        # every group has at most ROWS_PER_SLICE distinct values: the built-in
        # exact percentile with frequencies holds a map of that bounded size
        pct = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in probs]), F.col("__c"))
        agg = vals.groupBy(group).agg(pct.alias("__q"))
        return agg.select(group, F.posexplode("__q").alias("pi", "q")).select(
            group, "pi", F.element_at(F.array(*[F.lit(p) for p in probs]), F.col("pi") + 1).alias("p"), "q")
    cum = cumulative_counts(vals, group, value, ["__c"], buckets, n_groups=n_groups)
    n = vals.groupBy(group).agg(F.sum("__c").alias("__n"))
    # target ranks per group: for each p, floor and ceil of p*(n-1)
    pos = [F.lit(p) * (F.col("__n") - 1) for p in probs]
    tarr = n.select(group, F.array(*[
        F.struct(F.lit(i).alias("pi"), F.lit(p).alias("p"), F.floor(x).alias("lo_rank"), F.ceil(x).alias("hi_rank"),
                 (x - F.floor(x)).alias("frac"))
        for i, (p, x) in enumerate(zip(probs, pos))]).alias("__t"))  # len(probs) entries per group
    first = F.col("cum___c") - F.col("__c")
    last = F.col("cum___c") - 1

    def covers(rank):
        return (rank >= first) & (rank <= last)

    hits = (cum.join(broadcast_checked(tarr, known_rows=n_groups), group)
            .select(group, F.col(value).cast("double").alias("__v"), first.alias("__first"), last.alias("__last"),
                    F.explode(F.filter("__t", lambda t: covers(t["lo_rank"]) | covers(t["hi_rank"]))).alias("t"))
            .select(group, "__v", "__first", "__last", "t.*"))

    def hit(rank):
        return F.when((F.col(rank) >= F.col("__first")) & (F.col(rank) <= F.col("__last")), F.col("__v"))

    agg = hits.groupBy(group, "pi", "p", "frac").agg(F.max(hit("lo_rank")).alias("lo"), F.max(hit("hi_rank")).alias("hi"))
    return agg.select(group, "pi", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("q"))


def column_quantiles(df: DataFrame, cols, probs, buckets: int | None = None) -> DataFrame:
    """(column, pi, p, q): exact quantiles of several columns in one unpivoted pass."""
    cols = list(cols)
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
    return exact_quantiles(long, "column", "value", probs, buckets, n_groups=len(cols))


def scalar_quantile(df: DataFrame, col: str, p: float) -> float | None:
    """One exact quantile of one column, as a number."""
    rows = column_quantiles(df, [col], [p]).collect()
    return rows[0]["q"] if rows else None


# ---------------------------------------------------------------- selection in several passes

SKETCH = 10_000             # accuracy of the sketch: a rank is off by n / SKETCH at most
VALUES_PER_BRACKET = 2_000_000
_GRID = 200                 # steps of the sketch that narrows a bracket
_HELD = 1 << 20             # values inside brackets that a task holds before it sends them on


def _places(bounds: list[float], brackets: list[tuple[float, float]]) -> list[bool]:
    """Whether a place lies in one of ``brackets``: 2j is between bounds j - 1 and j, 2j + 1 on bound j."""
    out = []
    for k in range(2 * len(bounds) + 1):
        j = k // 2
        if k % 2:
            out.append(any(lo <= bounds[j] <= hi for lo, hi in brackets))
        else:
            out.append(0 < j < len(bounds) and any(lo <= bounds[j - 1] and bounds[j] <= hi for lo, hi in brackets))
    return out


def _placed_counts(rows: DataFrame, bounds: list[np.ndarray], inside: list[np.ndarray]) -> DataFrame:
    """(k, place, v, c): rows of column k in each place, by value inside the brackets (v is null outside)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside = [np.zeros(2 * len(b) + 1, dtype=np.int64) for b in bounds]
        held: list[list[np.ndarray]] = [[] for _ in bounds]

        def values(k: int) -> pa.RecordBatch:
            v, c = np.unique(np.concatenate(held[k]), return_counts=True)
            held[k] = []
            place = np.searchsorted(bounds[k], v, "left") + np.searchsorted(bounds[k], v, "right")
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k, np.int32)), pa.array(place.astype(np.int32)), pa.array(v), pa.array(c.astype(np.int64))],
                                              names=["k", "place", "v", "c"])

        for batch in batches:
            for k, b in enumerate(bounds):
                v = batch.column(k).drop_null().to_numpy(zero_copy_only=False)
                v = v[~np.isnan(v)]
                place = np.searchsorted(b, v, "left") + np.searchsorted(b, v, "right")
                kept = inside[k][place]
                outside[k] += np.bincount(place[~kept], minlength=len(outside[k]))
                held[k].append(v[kept])
                if sum(map(len, held[k])) > _HELD:
                    yield values(k)
        for k, n in enumerate(outside):
            if any(map(len, held[k])):
                yield values(k)
            at = np.flatnonzero(n)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.nulls(len(at), pa.float64()), pa.array(n[at])],
                                                 names=["k", "place", "v", "c"])

    return rows.mapInArrow(count, "k int, place int, v double, c long").groupBy("k", "place", "v").agg(F.sum("c").alias("c"))


def select_quantiles(df: DataFrame, cols, probs, most: int = VALUES_PER_BRACKET, sketch: int = SKETCH) -> DataFrame:
    """(column, pi, p, q): exact interpolated quantiles of several columns, like ``column_quantiles``, without
    collapsing the rows by value. Nulls and NaN are left out.

    A sketch brackets every wanted rank; one more pass counts the rows of each
    place between the brackets and keeps the distinct values inside them, about
    ``4 / sketch`` of the rows per rank. A bracket of more than ``most`` distinct
    values is narrowed by a sketch of its own rows and the pass is made again.
    Every pass is one scan; columns x probs bracket ends go through the driver,
    and the last step sorts one bracket per task.
    """
    from tillcast.session import cut_lineage
    spark, cols, probs = df.sparkSession, list(cols), [float(p) for p in probs]
    own = [F.col(f"`{c}`").cast("double") for c in cols]
    rows = df.select(*[F.when(~F.isnan(c), c).alias(f"c{k}") for k, c in enumerate(own)])
    eps = 2.0 / sketch
    asked = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-eps, eps)} | {0.0, 1.0})
    found = rows.agg(*[x for k in range(len(cols)) for x in (F.count(f"c{k}").alias(f"n{k}"), F.min(f"c{k}").alias(f"lo{k}"), F.max(f"c{k}").alias(f"hi{k}"),
                                                             F.percentile_approx(f"c{k}", asked, sketch).alias(f"s{k}"))]).first()
    n = [found[f"n{k}"] for k in range(len(cols))]
    brackets = []  # per column, an interval for every prob
    for k in range(len(cols)):
        at, few = dict(zip(asked, found[f"s{k}"] or [])), n[k] <= sketch  # of few rows the next rank may lie outside
        brackets.append([(found[f"lo{k}"] if few or p <= eps else at[p - eps], found[f"hi{k}"] if few or p + eps >= 1 else at[p + eps])
                         for p in probs] if n[k] else [])
    while True:
        bounds = [sorted({x for pair in pairs for x in pair}) for pairs in brackets]
        inside = [np.array(_places(b, pairs)) for b, pairs in zip(bounds, brackets)]
        counts = cut_lineage(_placed_counts(rows, [np.array(b, dtype=float) for b in bounds], inside))
        totals = [{} for _ in cols]  # a few places per rank: rows and distinct values
        for r in counts.groupBy("k", "place").agg(F.sum("c").alias("t"), F.count("v").alias("d")).collect():
            totals[r["k"]][r["place"]] = (r["t"], r["d"])
        big = [(k, place) for k, t in enumerate(totals) for place, (_, d) in t.items() if d > most]
        if not big:
            break
        brackets = _narrowed(rows, brackets, bounds, totals, n, probs, big, sketch)
    # the values of one place are sorted in one task; what lies before the place is known
    offsets = [(k, place, sum(x for q, (x, _) in t.items() if q < place)) for k, t in enumerate(totals) for place in t]
    offsets = spark.createDataFrame(offsets, "k int, place int, off long")
    run = Window.partitionBy("k", "place").orderBy("v")
    cum = counts.where(F.col("v").isNotNull()).join(F.broadcast(offsets), ["k", "place"]).select(
        "k", "v", (F.col("off") + F.sum("c").over(run)).alias("end"), "c")
    want = spark.createDataFrame([(k, cols[k], i, p, math.floor(p * (m - 1)), math.ceil(p * (m - 1)), p * (m - 1) - math.floor(p * (m - 1)))
                                  for k, m in enumerate(n) if m for i, p in enumerate(probs)],
                                 "k int, column string, pi int, p double, lo_rank long, hi_rank long, frac double")
    first, last = F.col("end") - F.col("c"), F.col("end") - 1

    def covers(rank):
        return (F.col(rank) >= first) & (F.col(rank) <= last)

    hits = cum.join(F.broadcast(want), "k").where(covers("lo_rank") | covers("hi_rank"))  # columns x probs rows
    agg = hits.groupBy("column", "pi", "p", "frac").agg(*[F.max(F.when(covers(r), F.col("v"))).alias(r[:2]) for r in ("lo_rank", "hi_rank")])
    return agg.select("column", "pi", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("q"))


def _narrowed(rows: DataFrame, brackets: list, bounds: list, totals: list, n: list[int], probs: list[float], big: list, sketch: int) -> list:
    """Brackets around the same ranks inside the places that hold too many values, from a sketch of those places' rows."""
    def within(k, place):  # between two bounds: a place on a bound has one value
        c = F.col(f"c{k}")
        return F.when((c > bounds[k][place // 2 - 1]) & (c < bounds[k][place // 2]), c)

    found = rows.agg(*[F.percentile_approx(within(k, place), [i / _GRID for i in range(_GRID + 1)], sketch).alias(f"s{j}") for j, (k, place) in enumerate(big)]).first()
    sketches = {at: found[f"s{j}"] for j, at in enumerate(big)}
    margin = 1 + math.ceil(2 * _GRID / sketch)  # the sketch's error, in steps

    def ends(k: int, rank: int) -> tuple[float, float]:
        below = 0
        for place in sorted(totals[k]):
            t = totals[k][place][0]
            if rank < below + t:
                break
            below += t
        if (k, place) in sketches:
            at, s = (rank - below) / max(1, t - 1) * _GRID, sketches[k, place]
            return s[max(0, math.floor(at) - margin)], s[min(_GRID, math.ceil(at) + margin)]
        b = bounds[k]
        return (b[place // 2], b[place // 2]) if place % 2 else (b[place // 2 - 1], b[place // 2])

    out = []
    for k, pairs in enumerate(brackets):
        both = [[ends(k, r) for r in (math.floor(p * (n[k] - 1)), math.ceil(p * (n[k] - 1)))] for p in probs] if pairs else []
        out.append([(min(x for x, _ in two), max(y for _, y in two)) for two in both])
    return out
