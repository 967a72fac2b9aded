"""Exact dedup by composable polynomial fingerprints and a chunkwise comparison.

Method. A text's fingerprint is the value of its UTF-8 bytes as a polynomial at
a base, modulo two primes below 2^31, next to its length. The fingerprint of a
concatenation follows from those of its parts (the left one times base^length
of the right one, plus the right one), so a huge text is cut into chunks that
are hashed in parallel in different tasks and combined in order; a text of one
chunk is hashed where it is read.

Equal fingerprints are compared before they count as equal texts. The texts of
a group stream through one aggregate per chunk number: where the least and the
greatest chunk agree, all agree. Copies collapse in the map tasks, so
a group of any size sends one chunk per task. A group in which a chunk differs
(a collision) is compared with its leading row, member by member, dealt over
salts by its size; members that differ start again with another base.

Row counts and leaders are gathered by (fingerprint, salt) first, so a
group that holds a third of all rows is no task's group, in joins either.

Edge cases: null texts are empty ones, which are equal to each other; rows of
null id stay only in groups without other ids; of several rows with the greatest
id of a group one stays; very long texts are never held beside each other, only
chunk by chunk; other columns are carried as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import carried, materialize
from tillcast.llm.wordhash import text_slices
from tillcast.sizing import broadcast_checked

PRIMES = (2147483647, 2147483629)
BASE_SEED = 0x5DEECE66D   # the bases of round r follow from this and r
CHUNK = 1 << 20           # bytes hashed, compared and shuffled in one piece
SALTS = 1024              # a group's rows meet in that many parts first
MEMBERS = 256             # members that one copy of a leader's chunk is compared with, on the average


def bases(rnd: int, primes: tuple[int, ...] = PRIMES) -> list[int]:
    """The base of each prime in one round; at least 257 where the prime allows, so that single bytes differ."""
    draw = [pow(6364136223846793005, rnd * len(primes) + k + 1, 1 << 64) ^ BASE_SEED for k in range(len(primes))]
    return [257 + (d >> 7) % (p - 300) if p > 600 else 1 + d % max(1, p - 1) for d, p in zip(draw, primes)]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^n modulo prime, by doubling."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) <= n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:n + 1]


def chunk_hashes(column: pa.Array, rnd: int, primes: tuple[int, ...]) -> list[np.ndarray]:
    """Hash and shift (base^length) of each byte string under each prime, as hash, shift, hash, shift ..."""
    tables, done = None, [[] for _ in range(2 * len(primes))]
    for data, off in text_slices(column):
        sizes = np.diff(off)
        longest = int(sizes.max(initial=0))
        if tables is None or len(tables[0]) <= longest:
            tables = [_powers(b, p, max(longest, 4096)) for b, p in zip(bases(rnd, primes), primes)]
        back = np.repeat(off[1:], sizes) - 1 - np.arange(len(data))  # bytes that follow in the same string
        value = data.astype(np.uint64) + np.uint64(1)
        full = sizes > 0
        for k, (p, power) in enumerate(zip(primes, tables)):
            h = np.zeros(len(sizes), dtype=np.uint64)
            if full.any():  # at most 2^20 terms below 2^40 each
                h[full] = np.add.reduceat(value * power[back], off[:-1][full]) % np.uint64(p)
            done[2 * k].append(h)
            done[2 * k + 1].append(power[sizes])
    return [np.concatenate(d) if d else np.zeros(0, np.uint64) for d in done]


def _hashed(data: Column, rnd: int, primes: tuple[int, ...]) -> Column:
    @F.arrow_udf(T.ArrayType(T.LongType()))
    def polynomial(column: pa.Array) -> pa.Array:
        flat = np.stack(chunk_hashes(column, rnd, primes), axis=1).astype(np.int64).ravel()
        return pa.FixedSizeListArray.from_arrays(pa.array(flat), 2 * len(primes)).cast(pa.list_(pa.int64()))
    return polynomial(data)


def chunks(df: DataFrame, text: str, no: str, part: str, chunk: int) -> DataFrame:
    """One row per ``chunk`` bytes of column ``text``: its number ``no`` and its bytes ``part``; none for an empty text."""
    data = F.col(text).cast("binary")
    numbered = df.withColumn(no, F.explode(F.when(F.octet_length(text) > 0, F.sequence(F.lit(0), F.floor((F.octet_length(text) - 1) / chunk).cast("int")))
                                           .otherwise(F.array().cast("array<int>"))))
    return numbered.withColumn(part, F.substring(data, F.col(no) * chunk + 1, F.lit(chunk))).drop(text)


def fingerprints(df: DataFrame, text: str, rnd: int = 0, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``text`` replaced by size (bytes) and fp (the hashes under all primes); texts of over ``chunk`` bytes are
    hashed chunk by chunk in parallel. ``df`` needs a unique column uid."""
    hs = [F.col("h")[2 * k] for k in range(len(primes))]
    fp = reduce(lambda a, b: F.shiftleft(a, 31).bitwiseXOR(b), hs)
    rest = [c for c in df.columns if c != text]
    short = df.filter(F.octet_length(text) <= chunk).select(*rest, F.octet_length(text).alias("size"), _hashed(F.col(text).cast("binary"), rnd, primes).alias("h"))
    pieces = chunks(df.filter(F.octet_length(text) > chunk).select("uid", text), text, "no", "part", chunk)
    pieces = pieces.repartition(F.col("uid"), F.col("no")).select("uid", "no", F.octet_length("part").alias("bytes"), _hashed(F.col("part"), rnd, primes).alias("h"))
    # left times base^length of the right one, plus the right one: below 2^62
    start = F.array(*[F.lit(v).cast("long") for _ in primes for v in (0, 1)])
    joined = F.aggregate(F.transform(F.array_sort(F.collect_list(F.struct("no", "h"))), lambda s: s["h"]), start, lambda left, right: F.array(*[
        v for k, p in enumerate(primes) for v in ((left[2 * k] * right[2 * k + 1] + right[2 * k]) % p, F.lit(1).cast("long"))]))
    long = pieces.groupBy("uid").agg(F.sum("bytes").cast("int").alias("size"), joined.alias("h"))
    long = df.filter(F.octet_length(text) > chunk).select(*rest).join(long, "uid").select(*rest, "size", "h")
    return short.unionByName(long).select(*rest, "size", fp.alias("fp"))


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` (uid, id, size, fp) plus n (rows of the same fingerprint) and lead (id and uid of the greatest id)."""
    key = ["size", "fp"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(SALTS)))
    part = salted.groupBy(*key, "salt").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "uid")).alias("lead"))
    whole = part.groupBy(*key).agg(F.sum("n").alias("n"), F.max("lead").alias("lead"))
    label = part.select(*key, "salt").join(whole, key)
    return salted.join(label, [*key, "salt"]).drop("salt")


def _collided(texts: DataFrame, grouped: DataFrame, chunk: int) -> DataFrame:
    """(uid, size, fp) of the rows whose text is not that of their group's lead."""
    key = ["size", "fp"]
    shared = grouped.filter("n > 1 AND size > 0 AND fp IS NOT NULL").select("uid", *key, "n", F.col("lead.uid").alias("head"))
    held = texts.join(broadcast_checked(shared), "uid")  # only texts that share their fingerprint go on
    pieces = chunks(held.select(*key, "text"), "text", "no", "part", chunk)
    mixed = (pieces.groupBy(*key, "no").agg(F.min("part").alias("least"), F.max("part").alias("most"))
             .groupBy(*key).agg(F.bool_and(F.col("least") == F.col("most")).alias("same")).filter("NOT same").select(*key))
    mixed = materialize(mixed, "exact-mixed")
    if mixed.isEmpty():
        return grouped.select("uid", *key).limit(0)
    # collisions only: each member against its group's lead
    held = texts.join(shared.join(broadcast_checked(mixed), key), "uid")
    salts = F.ceil(F.col("n") / MEMBERS).cast("int")
    leads = chunks(held.filter("uid = head"), "text", "no", "lead_part", chunk)
    leads = leads.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).select(*key, "no", "salt", "lead_part")
    members = chunks(held.filter("uid != head"), "text", "no", "part", chunk).withColumn("salt", F.pmod(F.xxhash64("uid"), salts).cast("int"))
    told = members.join(leads, [*key, "no", "salt"]).select("uid", *key, (F.col("part") == F.col("lead_part")).alias("same"))
    return told.groupBy("uid", *key).agg(F.bool_and("same").alias("same")).filter("NOT same").select("uid", *key)


def exact_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep_text: bool = True, out: str = "copies",
                 primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK) -> DataFrame:
    """``docs`` plus a struct ``out`` (a column of that name is replaced): keep_id (greatest id of the equal texts),
    group_size, and kept (true for one row per group)."""
    own = carried(docs.columns, out, *([] if keep_text else [text_col]))
    plain = [f"c{i}" for i in range(len(own))]
    work = docs.select(*[c.alias(n) for c, n in zip(own, plain)], F.col(f"`{id_col}`").alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # the row number is fixed once the table is written
    rows = materialize(work.withColumn("uid", F.monotonically_increasing_id()), "exact-rows")
    texts, settled, rnd = rows.select("uid", "id", "text"), None, 0
    while True:
        printed = materialize(fingerprints(texts, "text", rnd, primes, chunk), f"exact-fingerprints-{rnd}")  # hashed once
        grouped = materialize(_grouped(printed), f"exact-groups-{rnd}")
        wrong = materialize(_collided(texts.select("uid", "text"), grouped, chunk), f"exact-collided-{rnd}")
        done = grouped.select("uid", "size", "fp", "n", "lead")
        last = wrong.isEmpty()
        if not last:
            gone = wrong.groupBy("size", "fp").agg(F.count(F.lit(1)).alias("gone"))
            done = (done.join(wrong.select("uid"), "uid", "left_anti").join(broadcast_checked(gone), ["size", "fp"], "left")
                    .withColumn("n", F.col("n") - F.coalesce("gone", F.lit(0))))
        done = done.select("uid", "n", "lead")
        settled = done if settled is None else settled.unionByName(done)
        if last:
            break
        texts = rows.select("uid", "id", "text").join(broadcast_checked(wrong.select("uid")), "uid", "left_semi")
        rnd += 1
    names = [c for c in docs.columns if c.lower() != out.lower() and (keep_text or c.lower() != text_col.lower())]
    found = rows.select(*plain, "uid").join(settled, "uid")
    return found.select(*[F.col(p).alias(n) for p, n in zip(plain, names)], F.struct(
        F.col("lead.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("uid") == F.col("lead.uid")).alias("kept")).alias(out))
