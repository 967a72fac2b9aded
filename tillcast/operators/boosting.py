"""Gradient-boosted regression trees on histograms, several fits at once.

Features are cut at exact quantiles of the training rows into at most ``bins``
bins, and each fit's rows are packed into blocks of binned columns. A tree level
is one job for all fits: every block sums its rows' gradients and counts per
(fit, node, feature, bin), blocks of one fit are added up, and the best split of
every node goes back to the driver, a few numbers a node. Folds of a
cross-validation, the sizes of a learning curve and the final fit are fits of one
run, so six fits of 500 trees of depth 6 take 3,000 small jobs and not 18,000.

Splits maximise T(GL)^2/(HL+l2) + T(GR)^2/(HR+l2) - T(G)^2/(H+l2), with G the sum of
gradients (prediction minus label), H the number of sampled rows and T the soft
threshold at ``l1``; a leaf is -T(G)/(H+l2) times the learning rate. Rows are drawn
per tree by a hash of their key and columns per tree by the seed. A fit whose rows
lie in one block has nothing to add up, so its task grows ``CUT`` trees a job; the
trees are the same either way.

Gradients are rounded to a grid (a power of two, so fine that a block's sum is
exact in a double), and blocks are added as integers: a model does not depend on
how the rows are dealt. Blocks keep their predictions; every ``CUT`` trees those are
checkpointed, and a task that finds no state of its own starts from there, so a
lost executor repeats at most ``CUT`` trees of its blocks.

Null and NaN inputs are above every threshold. Rows without a label are left out. Equal gains
go to the first feature, then the least threshold.
"""

from __future__ import annotations

import statistics
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.ranks import column_quantiles
from tillcast.session import ensure_checkpoint_dir, materialize

BINS = 256               # bins of a feature, at most (a bin number is one byte)
BLOCK_ROWS = 1 << 16     # rows of a block
CUT = 25                 # trees between checkpoints of the predictions
LEAST_GAIN = 1e-6        # a split must gain more
MAX_FITS = 1 << 15
_STATES: dict[tuple, tuple] = {}  # in a worker: predictions of the blocks of the run in progress


@dataclass(frozen=True)
class Growth:
    """How trees grow; the fields of a model spec."""
    trees: int
    depth: int
    lr: float
    subsample: float = 1.0
    colsample: float = 1.0
    min_child: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    seed: int = 42

    @staticmethod
    def of(spec: dict, seed: int = 42) -> Growth:
        return Growth(seed=seed, **{k: spec[k] for k in Growth.__dataclass_fields__ if k in spec})


@dataclass
class Trees:
    """A fitted model: nodes in heap order (children of i: 2i + 1 and 2i + 2), -1 where a node is a leaf."""
    features: list[str]
    base: float
    feature: np.ndarray     # [tree, node]
    threshold: np.ndarray   # left where x <= threshold
    value: np.ndarray
    gain: np.ndarray

    def walk(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The value of one tree for rows of ``x`` [row, feature]."""
        f, t = self.feature[tree], self.threshold[tree]
        node = np.zeros(len(x), dtype=np.int64)
        if f[0] >= 0:
            rows = np.arange(len(x))
            for _ in range((len(f) + 1).bit_length() - 2):
                split = f[node]
                inner = split >= 0
                left = x[rows, np.maximum(split, 0)] <= t[node]
                node = np.where(inner, 2 * node + 2 - left, node)
        return self.value[tree][node]

    def values(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in range(len(self.feature)):
            out += self.walk(x, tree)
        return out

    def predict(self, df: DataFrame, out: str = "p") -> DataFrame:
        model = df.sparkSession.sparkContext.broadcast(self)  # trees x nodes numbers

        @F.pandas_udf("double")
        def boosted(*columns: pd.Series) -> pd.Series:
            return pd.Series(model.value.values(np.column_stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])))

        return df.withColumn(out, boosted(*[F.col(f"`{f}`").cast("double") for f in self.features]))

    def importances(self) -> list[float]:
        """Mean gain of each feature's splits, as a share of all features' sum."""
        total, used = np.zeros(len(self.features)), np.zeros(len(self.features))
        inner = self.feature >= 0
        np.add.at(total, self.feature[inner], self.gain[inner])
        np.add.at(used, self.feature[inner], 1)
        mean = total / np.maximum(used, 1)
        return (mean / mean.sum() if mean.sum() > 0 else mean).tolist()

    def rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, value, gain) of every node in use."""
        use = np.argwhere((self.feature >= 0) | (self.value != 0))
        return [(int(t), int(n), int(self.feature[t, n]), float(self.threshold[t, n]), float(self.value[t, n]), float(self.gain[t, n])) for t, n in use]

    @staticmethod
    def of_rows(features: list[str], base: float, shape: tuple[int, int], rows: Iterable[tuple]) -> Trees:
        made = Trees(list(features), base, np.full(shape, -1, np.int16), *(np.zeros(shape) for _ in range(3)))
        for t, n, f, threshold, value, gain in rows:
            made.feature[t, n], made.threshold[t, n], made.value[t, n], made.gain[t, n] = f, threshold, value, gain
        return made


# ---------------------------------------------------------------- growing, in tasks

def _walk_bins(nodes: np.ndarray, split: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """Heap index of every row's node in a tree over binned columns [feature, row]."""
    at, rows = np.zeros(bins.shape[1], dtype=np.int32), np.arange(bins.shape[1])
    for _ in range(depth):
        f = nodes[at]
        inner = f >= 0
        if not inner.any():
            break
        left = bins[np.maximum(f, 0), rows] <= split[at]
        at = np.where(inner, 2 * at + 2 - left, at).astype(np.int32)
    return at


def _drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray | None:
    """Rows of a tree's sample: a hash of the row's key and the tree below ``share``."""
    if share >= 1:
        return None
    h = key ^ np.uint64(((seed + 1) * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1342543DE82EF95) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) < np.uint64(int(share * (1 << 64)))


def drawn_columns(p: int, grow: Growth, tree: int) -> np.ndarray:
    """Columns of a tree, in ascending order."""
    if grow.colsample >= 1:
        return np.arange(p)
    return np.sort(np.random.default_rng([grow.seed, tree]).permutation(p)[:max(1, int(grow.colsample * p))])


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def best_splits(g: np.ndarray, h: np.ndarray, columns: np.ndarray, grow: Growth) -> list[tuple | None]:
    """For every node (gain, column, bin, G and H left, G and H right) of its best split, or None, from the sums of
    gradients and counts [node, column, bin]."""
    whole_g, whole_h = g[:, :1].sum(axis=2, keepdims=True), h[:, :1].sum(axis=2, keepdims=True)
    left_g, left_h = np.cumsum(g, axis=2)[:, :, :-1], np.cumsum(h, axis=2)[:, :, :-1]
    right_g, right_h = whole_g - left_g, whole_h - left_h
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (_soft(left_g, grow.l1) ** 2 / (left_h + grow.l2) + _soft(right_g, grow.l1) ** 2 / (right_h + grow.l2)
                - _soft(whole_g, grow.l1) ** 2 / (whole_h + grow.l2))
    least = max(grow.min_child, 1)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf).reshape(len(g), -1)
    if not gain.shape[1]:
        return [None] * len(g)
    out = []
    for k, at in enumerate(np.argmax(gain, axis=1).tolist()):
        c, b = divmod(at, left_g.shape[2])
        out.append((float(gain[k, at]), int(columns[c]), b, float(left_g[k, c, b]), float(left_h[k, c, b]), float(right_g[k, c, b]), float(right_h[k, c, b]))
                   if gain[k, at] > LEAST_GAIN else None)
    return out


class Tree:
    """A tree that grows level by level: nodes in heap order, -1 where a node is a leaf."""

    def __init__(self, depth: int):
        size = (1 << (depth + 1)) - 1
        self.feature, self.split = np.full(size, -1, np.int16), np.zeros(size, np.int16)
        self.value, self.gain, self.open = np.zeros(size), np.zeros(size), [0]

    def extend(self, depth: int, found: list[tuple], grow: Growth) -> None:
        """Take in (node, G, H, best split) of the open nodes of a level."""
        self.open = []
        for node, g, h, best in found:
            if depth == 0:
                self.value[0] = _leaf(g, h, grow)
            if best is None:
                continue
            gain, column, cut, lg, lh, rg, rh = best
            self.feature[node], self.split[node], self.gain[node], self.value[node] = column, cut, gain, 0.0
            self.value[2 * node + 1], self.value[2 * node + 2] = _leaf(lg, lh, grow), _leaf(rg, rh, grow)
            if depth + 1 < grow.depth:
                self.open += [2 * node + 1, 2 * node + 2]

    def walk(self, bins: np.ndarray, depth: int) -> np.ndarray:
        return _walk_bins(self.feature, self.split, bins, depth)


def _leaf(g: float, h: float, grow: Growth) -> float:
    return float(-_soft(np.float64(g), grow.l1) / (h + grow.l2) * grow.lr) if h + grow.l2 > 0 else 0.0


class _Job:
    """What a job needs to know: the run's settings, and each fit's trees since the blocks' last checkpoint, the open one included."""

    def __init__(self, run: str, grow: Growth, since: int, trees: dict[int, list[Tree]], grid: dict, width: int):
        self.run, self.grow, self.since, self.trees, self.grid, self.width = run, grow, since, trees, grid, width

    def advanced(self, block: dict, upto: int) -> np.ndarray:
        """The block's predictions after ``upto`` trees; a worker keeps its own from job to job."""
        key = (self.run, block["fit"], block["part"])
        if any(k[0] != self.run for k in _STATES):
            _STATES.clear()
        count, margin = _STATES.get(key, (-1, None))
        if not self.since <= count <= upto:
            count, margin = self.since, block["margin"]
        for tree in self.trees[block["fit"]][count - self.since:upto - self.since]:
            margin = margin + tree.value[tree.walk(block["bins"], self.grow.depth)]
        _STATES[key] = (upto, margin)
        return margin

    def sums(self, block: dict, number: int, tree: Tree) -> np.ndarray:
        """Sums [2, node, column, bin] of gradients (on the fit's grid) and counts of the open nodes of tree ``number``."""
        bins, width = block["bins"], self.width
        gradient = np.rint((self.advanced(block, number) - block["y"]) * self.grid[block["fit"]])
        slot = np.full(len(tree.feature), -1, dtype=np.int32)
        slot[tree.open] = np.arange(len(tree.open))
        at = slot[tree.walk(bins, self.grow.depth)]
        use = at >= 0
        picked = _drawn(block["key"], self.grow.seed, number, self.grow.subsample)
        if picked is not None:
            use &= picked
        rows = np.flatnonzero(use)
        base, gradient = at[rows].astype(np.int64) * width, gradient[rows]
        columns, nodes = drawn_columns(len(bins), self.grow, number), len(tree.open)
        out = np.zeros((2, nodes, len(columns), width), dtype=np.int64)
        for k, c in enumerate(columns):
            where = base + bins[c, rows]
            out[0, :, k] = np.bincount(where, weights=gradient, minlength=nodes * width).reshape(nodes, width)
            out[1, :, k] = np.bincount(where, minlength=nodes * width).reshape(nodes, width)
        return out

    def best(self, fit: int, number: int, nodes: list[int], sums: np.ndarray, p: int) -> list[tuple]:
        """(node, G, H, best split) from the added-up sums of some nodes."""
        g, h = sums[0] / self.grid[fit], sums[1].astype(float)
        found = best_splits(g, h, drawn_columns(p, self.grow, number), self.grow)
        return [(node, float(g[k, 0].sum()), float(h[k, 0].sum()), found[k]) for k, node in enumerate(nodes)]

    def level(self, block: dict) -> Iterator[tuple]:
        """((fit, node), sums) of one block for the open nodes of the last tree."""
        tree = self.trees[block["fit"]][-1]
        sums = self.sums(block, self.since + len(self.trees[block["fit"]]) - 1, tree) if tree.open else None
        for k, node in enumerate(tree.open):
            yield (block["fit"], node), sums[:, k:k + 1]

    def chosen(self, item: tuple, p: int) -> tuple:
        """(fit, (node, G, H, best split)) of a node's sums over all blocks."""
        (fit, node), sums = item
        return fit, self.best(fit, self.since + len(self.trees[fit]) - 1, [node], sums, p)[0]

    def whole(self, block: dict, upto: int) -> tuple[int, list[Tree]]:
        """(fit, its trees up to ``upto``): for a fit of one block, whose sums need no other task."""
        fit, p = block["fit"], len(block["bins"])
        grown = []
        for number in range(self.since, upto):
            tree = Tree(self.grow.depth)
            for depth in range(self.grow.depth):
                if tree.open:
                    tree.extend(depth, self.best(fit, number, tree.open, self.sums(block, number, tree), p), self.grow)
            grown.append(tree)
            self.trees[fit].append(tree)
        return fit, grown


def _blocks(df: DataFrame, features: list[str], edges: list[np.ndarray], parts: int) -> DataFrame:
    """One row per fit and partition: its rows' bins, labels and keys, packed. ``df``: __fits, __y, __key and c0, c1 ..."""
    p = len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def row(fit: int) -> pa.RecordBatch:
            bins, y, key = (np.concatenate(x, axis=-1) for x in zip(*held.pop(fit)))
            return pa.RecordBatch.from_arrays([pa.array([fit], pa.int32()), pa.array([y.size], pa.int32()), *[
                pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (bins, y, key)]], names=["fit", "n", "bins", "y", "key"])

        for batch in batches:
            x = [batch.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(p)]
            bins = np.stack([np.searchsorted(e, v) for e, v in zip(edges, x)]).astype(np.uint8) if p else np.zeros((0, len(batch)), np.uint8)
            y, key = batch.column("__y").to_numpy(zero_copy_only=False), batch.column("__key").to_numpy().view(np.uint64)
            fits = batch.column("__fits")
            owner, flat = pc.list_parent_indices(fits).to_numpy(), pc.list_flatten(fits).to_numpy()
            for fit in np.unique(flat).tolist():
                rows = owner[flat == fit]
                for a in range(0, len(rows), BLOCK_ROWS):
                    held.setdefault(fit, []).append((bins[:, rows[a:a + BLOCK_ROWS]], y[rows[a:a + BLOCK_ROWS]], key[rows[a:a + BLOCK_ROWS]]))
                    if sum(len(h[1]) for h in held[fit]) >= BLOCK_ROWS:
                        yield row(fit)
        for fit in list(held):
            yield row(fit)

    return df.repartition(parts).mapInArrow(pack, "fit int, n int, bins binary, y binary, key binary")


def _unpacked(r, p: int, base: dict[int, float]) -> tuple[int, dict]:
    """A block ready for use; labels and predictions as doubles."""
    y = np.frombuffer(r["y"], dtype=np.float64)
    return r["part"], {"fit": r["fit"], "part": r["part"], "y": y, "key": np.frombuffer(r["key"], dtype=np.uint64),
                       "bins": np.frombuffer(r["bins"], dtype=np.uint8).reshape(p, len(y)), "margin": np.full(len(y), base[r["fit"]])}


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Distinct exact quantiles of each feature, at most ``bins`` - 1 of them; a bin ends at its edge (x <= edge)."""
    quantiles = column_quantiles(df, features, [i / bins for i in range(1, bins)])
    found = {f: [] for f in features}
    for r in quantiles.collect():  # features x bins numbers
        found[r["column"]].append(r["q"])
    return [np.unique(np.array(found[f], dtype=float)) for f in features]


def fit_many(df: DataFrame, features: list[str], label: str, spec: dict, fits: list[Column], seed: int = 42,
             bins: int = BINS, block_rows: int = BLOCK_ROWS, key: Column | None = None) -> list[Trees]:
    """One model per condition of ``fits`` (the rows it learns from), all grown together.

    Bins are cut over the rows that any fit learns from. ``key`` tells rows apart for the draws (default: a hash of all columns)."""
    features = list(features)
    if not 0 < len(fits) <= MAX_FITS:
        raise ValueError("no fits, or too many at once")
    spark, grow = df.sparkSession, Growth.of(spec, seed)
    named = [F.col(f"`{f}`").cast("double").alias(f"c{i}") for i, f in enumerate(features)]
    y = F.col(f"`{label}`").cast("double")
    rows = df.select(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(fits)])).cast("array<int>").alias("__fits"), y.alias("__y"),
                     (F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if key is None else key).alias("__key"), *named)
    rows = materialize(rows.filter((F.size("__fits") > 0) & F.col("__y").isNotNull()), "boosting-rows")
    about = rows.select(F.explode("__fits").alias("fit"), "__y").groupBy("fit").agg(
        F.count(F.lit(1)).alias("n"), F.avg("__y").alias("base"), F.min("__y").alias("lo"), F.max("__y").alias("hi")).collect()  # a row per fit
    base = {r["fit"]: r["base"] for r in about}
    # the finest grid on which a block's sums stay below 2^52 and all sums below 2^62
    grid = {r["fit"]: 2.0 ** np.floor(min(52 - np.log2(min(r["n"], block_rows) * 4.0), 62 - np.log2(r["n"] * 4.0))
                                      - np.log2(max(r["hi"] - r["lo"], 1e-30))) for r in about}
    edges = bin_edges(rows, [f"c{i}" for i in range(len(features))], bins)
    width = max([len(e) for e in edges], default=0) + 1
    parts = max(1, -(-max([r["n"] for r in about], default=0) // block_rows))
    packed = materialize(_blocks(rows, features, edges, parts).withColumn("part", F.monotonically_increasing_id()), "boosting-blocks")
    ids = {r["part"]: k for k, r in enumerate(packed.select("part").orderBy("part").collect())}  # a row per block
    p = len(features)
    blocks = packed.rdd.map(lambda r: _unpacked(r, p, base)).partitionBy(max(1, len(ids)), lambda part: ids[part]).values().persist(StorageLevel.MEMORY_AND_DISK)
    ensure_checkpoint_dir(spark)
    run, grown = uuid.uuid4().hex, {f: [] for f in base}
    for since in range(0, grow.trees if base else 0, CUT):
        upto = min(since + CUT, grow.trees)
        recent = {f: [] for f in base}
        if len(ids) == len(base):  # one block a fit: nothing to add up between the levels
            job = _Job(run, grow, since, {f: [] for f in base}, grid, width)
            for f, trees in blocks.map(lambda b, job=job, upto=upto: job.whole(b, upto)).collect():  # trees x nodes numbers
                recent[f] = trees
        else:
            for _ in range(since, upto):
                for f in base:
                    recent[f].append(Tree(grow.depth))
                for depth in range(grow.depth):
                    if not any(recent[f][-1].open for f in base):
                        break
                    job = _Job(run, grow, since, recent, grid, width)
                    sums = blocks.flatMap(job.level).reduceByKey(np.add)
                    found = {f: [] for f in base}
                    for f, node in sums.map(lambda item, job=job: job.chosen(item, p)).collect():  # a few numbers a node
                        found[f].append(node)
                    for f in base:
                        recent[f][-1].extend(depth, sorted(found[f], key=lambda x: x[0]), grow)
        for f in base:
            grown[f] += recent[f]
        if upto < grow.trees:
            job = _Job(run, grow, since, recent, grid, width)
            moved = blocks.map(lambda b, job=job, upto=upto: b | {"margin": job.advanced(b, upto)}).persist(StorageLevel.MEMORY_AND_DISK)
            moved.checkpoint()
            moved.count()
            blocks.unpersist()
            blocks = moved
    blocks.unpersist()
    return [_model(features, base.get(f, 0.0), grown.get(f, []), grow, edges) for f in range(len(fits))]


def _model(features: list[str], base: float, trees: list[Tree], grow: Growth, edges: list[np.ndarray]) -> Trees:
    shape = (grow.trees, (1 << (grow.depth + 1)) - 1)
    out = Trees(features, base, np.full(shape, -1, np.int16), *(np.zeros(shape) for _ in range(3)))
    for t, tree in enumerate(trees):
        out.feature[t], out.value[t], out.gain[t] = tree.feature, tree.value, tree.gain
        for node in np.flatnonzero(tree.feature >= 0):
            out.threshold[t, node] = edges[tree.feature[node]][tree.split[node]]
    return out


# ---------------------------------------------------------------- errors

def errors_by(df: DataFrame, models: list[Trees], label: str, groups: Column) -> dict[tuple[int, str], tuple[int, float]]:
    """{(model, side): (rows, sum of squared errors)} in one pass; ``groups`` gives each row's array of structs (model, side)."""
    features = models[0].features
    held = df.sparkSession.sparkContext.broadcast(models)
    rows = df.select(F.explode(groups).alias("g"), F.col(f"`{label}`").cast("double").alias("y"),
                     *[F.col(f"`{f}`").cast("double").alias(f"c{i}") for i, f in enumerate(features)])
    rows = rows.select(F.col("g.model").alias("model"), F.col("g.side").alias("side"), "y", *[f"c{i}" for i in range(len(features))]).filter("y IS NOT NULL")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = pdf.iloc[:, 3:].to_numpy(dtype=float), pdf["y"].to_numpy()
            out = []
            for (model, side), at in pdf.groupby(["model", "side"]).indices.items():
                miss = held.value[model].values(x[at]) - y[at]
                out.append((model, side, len(at), float(miss @ miss)))
            yield pd.DataFrame(out, columns=["model", "side", "n", "sse"])

    sums = rows.mapInPandas(score, "model int, side string, n long, sse double")
    return {(r["model"], r["side"]): (r["n"], r["sse"]) for r in sums.groupBy("model", "side").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse")).collect()}


def rmse_of(found: tuple[int, float]) -> float:
    return float(np.sqrt(found[1] / found[0]))


def staged_errors(df: DataFrame, model: Trees, label: str = "y", every: int = 10) -> DataFrame:
    """(trees, n, rmse, mae) after every ``every`` trees and after all of them, in one pass over the rows."""
    held = df.sparkSession.sparkContext.broadcast(model)
    total = len(model.feature)
    stages = sorted({*range(every, total + 1, every), total})

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y, model_ = pdf.iloc[:, 1:].to_numpy(dtype=float), pdf["y"].to_numpy(), held.value
            p, out, at = np.full(len(y), model_.base), [], 0
            for stage in stages:
                while at < stage:
                    p += model_.walk(x, at)
                    at += 1
                out.append((stage, len(y), float(((p - y) ** 2).sum()), float(np.abs(p - y).sum())))
            yield pd.DataFrame(out, columns=["trees", "n", "sse", "sae"])

    rows = df.select(F.col(f"`{label}`").cast("double").alias("y"), *[F.col(f"`{f}`").cast("double").alias(f"c{i}") for i, f in enumerate(model.features)])
    sums = rows.filter("y IS NOT NULL").mapInPandas(score, "trees int, n long, sse double, sae double")
    return sums.groupBy("trees").agg(F.sum("n").alias("n"), F.sqrt(F.sum("sse") / F.sum("n")).alias("rmse"), (F.sum("sae") / F.sum("n")).alias("mae"))


def spread(scores: list[float]) -> dict:
    return {"cv_rmse_folds": scores, "cv_rmse_mean": statistics.fmean(scores), "cv_rmse_std": statistics.pstdev(scores)}
