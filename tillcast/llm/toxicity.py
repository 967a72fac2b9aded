"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text: its words (A-Z lower-cased runs of ASCII letters and digits
and non-ASCII characters), the stems of longer words (their first 4 to 8 bytes,
so that inflected forms share a coordinate), its word pairs and its pairs with
one word between them, each hashed into ``2**bits`` coordinates; a coordinate
counts once per text. Training is FTRL-proximal: every coordinate has its own learning rate
from the sum of its squared gradients, and the L1 term keeps coordinates at
exactly zero, so the model is a short sorted list of (coordinate, weight). The
list, at most ``2**bits`` entries and far fewer in practice, is broadcast.

The model is fitted on at most ``max_rows`` labelled rows, those of the least
hash of the id (documented bound; the same rows whatever the partitioning).
Every text is scored whole.

Edge cases: null and empty texts score with the bias alone; null labels are
not learnt from; an id labelled more than once counts with its largest label;
without any labelled row the score is 0.5 and the prediction 1 is avoided by
the bias of an untrained model being slightly negative; repeated rows score
alike; very long texts are scored whole; an empty table gives an empty result; other
columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.memory import give_back, lean, settle
from tillcast.llm.store import least_by_hash, materialize, small_batches
from tillcast.llm.wordhash import mix, owner, range_hasher, text_slices, word_bounds

MAX_ROWS = 10_000
BITS = 20
STEMS = (4, 5, 6, 7, 8)
# with L1 at 4 a coordinate must have helped on several texts before it gets a weight
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.1
EPOCHS = 4
UNTRAINED_BIAS = -1e-6
AT_ONCE = 1 << 17  # bytes of text whose features are held at a time
_PAIR, _SKIP = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_STEM = np.uint64(0xA0761D6478BD642F)


def _features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text index, coordinate) of every word, stem, pair and skip pair of a slice."""
    low, starts, ends, first = word_bounds(data, offsets)
    hashes, doc = range_hasher(low), owner(first)
    words = hashes(starts, ends)
    shift = np.uint64(64 - bits)
    docs, coords = [doc], [words >> shift]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        same = doc[:-gap] == doc[gap:]
        docs.append(doc[:-gap][same])
        coords.append(mix(words[:-gap][same] * salt + words[gap:][same]) >> shift)
    for size in STEMS:
        longer = np.flatnonzero(ends - starts > size)
        docs.append(doc[longer])
        coords.append(mix(hashes(starts[longer], starts[longer] + size) ^ _STEM) >> shift)
    return np.concatenate(docs), np.concatenate(coords).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression with L1 and L2 terms."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.bias_z = self.bias_n = 0.0
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        return np.where(np.abs(z) <= self.l1, 0.0,
                        (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def bias(self) -> float:
        return -self.bias_z * self.alpha / (self.beta + self.bias_n ** 0.5)

    def learn(self, i: np.ndarray, label: float) -> None:
        w = self.weights(i)
        b = self.bias()
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g
        self.bias_z += g - ((self.bias_n + g * g) ** 0.5 - self.bias_n ** 0.5) / self.alpha * b
        self.bias_n += g * g


MODEL_SCHEMA = T.StructType([T.StructField("coordinate", T.LongType()), T.StructField("weight", T.DoubleType())])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
        max_rows: int = MAX_ROWS, bits: int = BITS, epochs: int = EPOCHS) -> list[tuple[int, float]]:
    """Non-zero weights (coordinate -1: the bias), learnt from the rows of ``labels``."""
    lab = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(f"`{id_col}`").alias("_id")).agg(F.max(F.col(label_col)).cast("double").alias("_label"))
           .withColumn("_order", F.xxhash64(F.col("_id").cast("string"))))
    text = docs.filter(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    chosen = materialize(least_by_hash(lab, "_order", max_rows), "toxicity-sample")  # at most max_rows narrow rows
    picked = text.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]).select("_order", "_id", "_label", "_text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for b in batches:
            y, at = b.column("_label").to_pylist(), 0
            rank = list(zip(b.column("_order").to_pylist(), b.column("_id").cast(pa.string()).to_pylist()))
            for data, offsets in text_slices(b.column("_text"), AT_ONCE):
                d, c = _features(data, offsets, bits)
                pairs = np.unique((d.astype(np.int64) << bits) | c)
                cuts = np.searchsorted(pairs >> bits, np.arange(len(offsets)))
                for k in range(len(offsets) - 1):
                    examples.append((rank[at + k], (pairs[cuts[k]:cuts[k + 1]] & ((1 << bits) - 1)).astype(np.int32), y[at + k]))
                at += len(offsets) - 1
        examples.sort(key=lambda e: e[0])  # the same order however the rows arrived
        model = Ftrl(bits)
        for _ in range(epochs):
            for _, i, label in examples:
                model.learn(i, label)
        hot = np.flatnonzero(np.abs(model.z) > model.l1)
        bias = model.bias() if examples else UNTRAINED_BIAS
        yield pa.RecordBatch.from_arrays([pa.array([-1, *hot.tolist()], pa.int64()),
                                          pa.array([bias, *model.weights(hot).tolist()], pa.float64())], ["coordinate", "weight"])

    rows = picked.repartition(1).mapInArrow(lean(train), MODEL_SCHEMA).collect()
    return [(r["coordinate"], r["weight"]) for r in rows] or [(-1, UNTRAINED_BIAS)]


def score_column(text: Column, model, bits: int = BITS) -> Column:
    """Probability that a text is toxic; ``model`` is a broadcast of ``fit``'s list."""
    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        settle()
        known = dict(model.value)
        bias = known.pop(-1)
        table = np.zeros(1 << bits, dtype=np.float64)
        table[list(known)] = list(known.values())
        used = table != 0
        parts = [np.zeros(0)]
        for data, offsets in text_slices(column, AT_ONCE):
            d, c = _features(data, offsets, bits)
            keep = used[c]
            pairs = np.unique((d[keep] << bits) | c[keep])
            total = np.bincount(pairs >> bits, weights=table[pairs & ((1 << bits) - 1)], minlength=len(offsets) - 1)
            parts.append(1.0 / (1.0 + np.exp(-np.clip(total + bias, -35, 35))))
            del d, c, keep, pairs, total
        give_back()
        return pa.array(np.concatenate(parts), pa.float64())
    return score(text)


def held_out(ident: Column, folds: int = 5, fold: int = 0) -> Column:
    """True where crc32 of the id's text falls in the held-out fold; false for a null id."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
             max_rows: int = MAX_ROWS, out: str = "toxicity") -> DataFrame:
    """``docs`` plus ``out``, a score from 0 to 1 (a column of that name is replaced); learns from labels outside the held-out fold only."""
    small_batches(docs.sparkSession)
    learn = labels.filter(~held_out(F.col(f"`{id_col}`")))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, learn, text_col, id_col, label_col, max_rows))
    return docs.withColumn(out, score_column(F.col(f"`{text_col}`"), model))
