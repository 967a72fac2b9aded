"""SimHash near-duplicates: segment popcounts on a grid, Manhattan lower bound, exact check.

Method. A fingerprint of 64 bits is mapped to 32 counts, one per segment of
two bits. One differing bit changes one count by one, so the Manhattan
distance of two count vectors is never above the bit distance: it is a lower
bound, and vectors that are close on the grid are the only candidates. The
counts are grouped into ``max_bits + 3`` blocks of coordinates; vectors
within Manhattan distance ``max_bits`` agree on all but ``max_bits`` blocks, so
every link meets in at least one grid cell of a three-block projection.
Candidates of a cell pass the Manhattan bound and then the exact bit
distance. Only distinct fingerprints enter the join: copies share one.

Dense cells. A cell that holds more than ``cell_cap`` fingerprints is not
paired up. Its members instead meet at their one-bit neighbours: two
fingerprints are within two bits iff they share a point at distance one or
less from both (the bits flipped one at a time), all members of such a point
(65 at most) are linked to its least one, and the links are exact. The
cap moves work from one exact way to the other and drops nothing.
The neighbour argument holds for ``max_bits`` 2, the contract's distance; at other
distances all cells are paired.

Edge cases: null and empty texts have no words and fingerprint zero, linked
like any other; a null id takes part and gets the component's smallest
non-null id (null if there is none); repeated rows are equal fingerprints and
share a component; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.components import connected_components
from tillcast.llm.store import carried, fresh, materialize
from tillcast.llm.wordhash import each_text

SHINGLE = 3
MAX_BITS = 2
CELL_CAP = 64
SEED = 42
_LOW = 0x5555555555555555  # the low bit of every two-bit segment
_BLOCKED = 1 << 18         # hashes turned into bits at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint of one text; unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else (words,)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(g), seed) for g in grams), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _BLOCKED):
        part = h[i:i + _BLOCKED].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """Fingerprint as a signed long."""
    @F.arrow_udf(T.LongType())
    def simhash64(column: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t, shingle, seed) for t in each_text(column)), dtype=np.uint64, count=len(column))
        return pa.array(out.view(np.int64))
    return simhash64(text)


def segment_counts(fp: Column) -> Column:
    """The 32 two-bit popcounts of a fingerprint, packed into one long."""
    low, high = fp.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed count vectors (each count is 0, 1 or 2:
    their xor is 01 or 11 at distance one and 10 at distance two)."""
    x = a.bitwiseXOR(b)
    low = x.bitwiseAND(F.lit(_LOW))
    high = F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(_LOW))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def projections(max_bits: int) -> list[int]:
    """Masks over the packed counts, one per choice of three of ``max_bits + 3`` blocks."""
    blocks = max_bits + 3
    edges = [round(i * 32 / blocks) for i in range(blocks + 1)]
    masks = [sum(0b11 << (2 * s) for s in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [_signed(sum(c)) for c in combinations(masks, 3)]


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_cap: int = CELL_CAP) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that give the same
    components as all pairs within ``max_bits``: every pair of a sparse cell, and
    star links around shared neighbours in dense cells."""
    masks = projections(max_bits)
    counts = segment_counts(F.col("fp"))
    cells = fps.select("fp", F.posexplode(F.array(*[counts.bitwiseAND(F.lit(m)) for m in masks])).alias("proj", "cell"))
    load = cells.groupBy("proj", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowded = materialize(cells.join(load, ["proj", "cell"]), "simhash-cells")
    sparse = crowded.filter(F.col("n") <= cell_cap) if max_bits == 2 else crowded
    a = sparse.select("proj", "cell", F.col("fp").alias("a"))
    b = sparse.select("proj", "cell", F.col("fp").alias("b"))
    near = manhattan(segment_counts(F.col("a")), segment_counts(F.col("b"))) <= max_bits
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = a.join(b, ["proj", "cell"]).filter(F.col("a") < F.col("b")).filter(near).filter(exact).select("a", "b")
    if max_bits != 2:
        return pairs.distinct()
    dense = crowded.filter(F.col("n") > cell_cap).select("fp").distinct()
    around = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)]
    points = dense.select("fp", F.explode(F.array(*around)).alias("point"))
    least = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = points.join(least, "point").filter(F.col("a") < F.col("fp")).select("a", F.col("fp").alias("b"))
    stars = stars.filter(exact)
    return pairs.unionByName(stars).distinct()


def simhash_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, cell_cap: int = CELL_CAP, keep_text: bool = True, out: str = "near_copies") -> DataFrame:
    """``docs`` plus a struct ``out`` (a column of that name is replaced): fingerprint (16 hex
    digits), component_id (smallest id reachable through links) and is_first (true for
    one row per component: smallest id, ties by an arbitrary fixed row)."""
    spark = docs.sparkSession
    own = carried(docs.columns, out, *([] if keep_text else [text_col]))
    x = fresh("_simhash", docs.columns)
    fp, uid = f"{x}_fp", f"{x}_uid"
    # the row number is fixed once the table is written
    tagged = materialize(docs.select(*own, *([F.col(f"`{id_col}`").alias(f"{x}_id")]), fingerprint_column(F.col(f"`{text_col}`"), shingle).alias(fp))
                         .withColumn(uid, F.monotonically_increasing_id()), "simhash-tagged")
    ident = F.col(f"{x}_id")
    order = F.struct(ident.isNull().alias("none"), ident.alias("id"), F.col(uid).alias("uid"))
    fps = materialize(tagged.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("least")), "simhash-distinct")
    comp = connected_components(spark, links(fps.select("fp"), max_bits, cell_cap))
    nodes = fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = nodes.groupBy("root").agg(F.min("least").alias("head"))
    label = nodes.join(heads, "root").select(F.col("fp").alias(f"{x}_node"), F.col("head").alias(f"{x}_head"))
    found = tagged.join(label, F.col(fp) == F.col(f"{x}_node"))
    return found.select(*own, F.struct(
        F.lower(F.lpad(F.hex(fp), 16, "0")).alias("fingerprint"), F.col(f"{x}_head.id").alias("component_id"),
        (F.col(uid) == F.col(f"{x}_head.uid")).alias("is_first")).alias(out))
