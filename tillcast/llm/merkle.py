"""Merkle manifest of a dataset: one root, and for every row a witness that folds to it.

Leaves are SHA-256 digests of the rows' fields; per group they are ordered by id
and paired level by level (an odd last node is hashed alone) until one subroot
is left, and the subroots of the groups, in order, give the root the same way.

Method. Incremental witnesses: nodes are appended to a stack of open subtrees
of aligned power-of-two sizes. Every member of an open subtree has a partial
witness; when a sibling subtree completes, the two merge, and the members of
each are given the other's digest. Closing the stack hashes what is alone up to
the tree's height. A group's leaves are dealt as aligned blocks of 2^12, whatever
its size; block roots are appended in the same way as the nodes of the next
round, in blocks of their own, until each group has one node. Only then are the
witnesses built from the top down: a block begins with the witness of its root,
and its members' witnesses end with it. The subroots are one more group of
nodes. No task holds more than a block, and no digest goes to the driver.

Positions come from a range sort by (group, id, leaf) written once, with row
counts per file added up: no window runs over a group's rows.

A witness is an array of steps from the leaf up: ``L`` or ``R`` and the
sibling's digest (on that side), or ``-`` where the node is hashed alone.

Edge cases: null fields count as ``-``; a null group is one group, the first; null
ids come first; rows of one id are ordered by their leaves, equal rows in any
order (their digests are equal); empty and very long texts are ordinary fields; an
empty table gives an empty result; other columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.store import carried, materialize
from tillcast.sizing import broadcast_checked

LEVELS = 12       # a block is an aligned subtree of 2^12 nodes
ROWS_OUT = 2048   # rows of an outgoing batch


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its byte count, a colon and its text (integers decimal)."""
    def one(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Appender:
    """Open subtrees of one block of a tree, with a witness per member."""

    def __init__(self, witnesses: bool = True):
        self.open: list[tuple[int, str, int]] = []  # level, digest, first member
        self.paths: list[list[str]] = []
        self.members = 0
        self.witnesses = witnesses

    def append(self, digest: str) -> None:
        self.open.append((0, digest, self.members))
        self.members += 1
        if self.witnesses:
            self.paths.append([])
        self._merge()

    def _merge(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            level, right, b = self.open.pop()
            _, left, a = self.open.pop()
            for path in self.paths[a:b]:
                path.append("R" + right)
            for path in self.paths[b:]:
                path.append("L" + left)
            self.open.append((level + 1, _digest(left + right), a))

    def close(self, height: int) -> str:
        """The subtree's root at ``height``; nodes without a sibling are hashed alone."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, digest, a = self.open.pop()
            for path in self.paths[a:]:
                path.append("-")
            self.open.append((level + 1, _digest(digest), a))
            self._merge()
        return self.open[0][1]


def _height(nodes: int, levels: int) -> int:
    """Levels of a block in a group of so many nodes."""
    return levels if nodes > 1 << levels else (nodes - 1).bit_length()


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Rows of a block side by side and in order; ``nodes`` has grp, pos, n, digest."""
    return nodes.withColumn("block", F.shiftright("pos", levels)).repartition("grp", "block")


def _roots(nodes: DataFrame, levels: int) -> DataFrame:
    """The roots of all blocks, as the nodes of the next round."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, n, tree = None, 0, None

        def close() -> None:
            if tree is not None:
                done.append((key[0], key[1], -(-n >> levels), tree.close(_height(n, levels))))

        for batch in batches:
            for grp, block, n_now, digest in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if (grp, block) != key:
                    close()
                    key, n, tree = (grp, block), n_now, Appender(witnesses=False)
                tree.append(digest)
            if len(done) >= ROWS_OUT:
                yield _rows(done)
                done = []
        close()
        if done:
            yield _rows(done)

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["grp", "pos", "n", "digest"])

    sorted_ = _in_blocks(nodes.select("grp", "pos", "n", "digest"), levels).sortWithinPartitions("grp", "block", "pos")
    return sorted_.select("grp", "block", "n", "digest").mapInArrow(fold, "grp string, pos long, n long, digest string")


def _witnessed(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """``nodes`` plus a whole witness; ``above`` has the witness ``up`` of every block's root by (grp, pos)."""
    rest = [c for c in nodes.columns if c not in ("grp", "pos", "n", "digest")]
    above = above.select(F.col("grp").alias("_grp"), F.col("pos").alias("_block"), "up")
    placed = _in_blocks(nodes, levels).join(broadcast_checked(above), (F.col("grp") == F.col("_grp")) & (F.col("block") == F.col("_block")))
    first = F.when(F.col("pos") == F.shiftleft("block", levels), F.col("up")).alias("up")  # once per block
    sorted_ = placed.sortWithinPartitions("grp", "block", "pos").select("grp", "block", "pos", "n", "digest", first, *rest)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key, n, tree, up = None, 0, None, []

        def close() -> Iterator[pa.RecordBatch]:
            if tree is None:
                return
            tree.close(_height(n, levels))
            at = 0
            for part in held:
                for a in range(0, len(part), ROWS_OUT):
                    piece = part.slice(a, ROWS_OUT)
                    paths = [p + up for p in tree.paths[at:at + len(piece)]]
                    at += len(piece)
                    yield pa.RecordBatch.from_arrays([piece.column(0), *[piece.column(i) for i in (2, 3, 4)], *[piece.column(i) for i in range(6, piece.num_columns)],
                                                      pa.array(paths, pa.list_(pa.string()))], names=names)

        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            digests, counts = batch.column(4).to_pylist(), batch.column(3).to_pylist()
            a = 0
            while a < len(keys):
                if keys[a] != key:
                    yield from close()
                    held, key, n, tree = [], keys[a], counts[a], Appender()
                    up = batch.column(5)[a].as_py()
                b = a
                while b < len(keys) and keys[b] == key:
                    tree.append(digests[b])
                    b += 1
                held.append(batch.slice(a, b - a))
                a = b
        yield from close()

    kinds = {f.name: f.dataType for f in sorted_.schema.fields}
    names = ["grp", "pos", "n", "digest", *rest, "witness"]
    schema = T.StructType([T.StructField(c, kinds[c]) for c in names[:-1]] + [T.StructField("witness", T.ArrayType(T.StringType()))])
    return sorted_.mapInArrow(extend, schema)


def positions(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` plus pos (from 0, in order within column grp) and n (rows of the group). Rows are range-sorted over
    all tasks and written; a file's rows of a group are counted, and the counts added up."""
    keys = ["grp", *order, "_tie"]
    dealt = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("grp", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy("grp")
    runs = runs.select(F.col("grp").alias("_grp"), F.col("_part").alias("_file"), "_first", F.sum("_rows").over(whole).alias("n"),
                       (F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")).alias("_before"))
    placed = rows.join(broadcast_checked(runs), (F.col("grp") == F.col("_grp")) & (F.col("_part") == F.col("_file")))
    return placed.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_grp", "_file", "_part", "_at", "_first", "_before")


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes of every round; in the last one each group has its root."""
    rounds = [nodes]
    while True:
        rounds.append(materialize(_roots(rounds[-1], levels), f"merkle-round-{len(rounds)}"))
        if (rounds[-1].agg(F.max("n")).first()[0] or 1) <= 1:
            return rounds


def _descend(rounds: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The first round's nodes with whole witnesses; ``above``: (grp, pos, up) of the roots."""
    for nodes in rounds[-2:0:-1]:
        found = _witnessed(nodes, above, levels)
        above = materialize(found.select("grp", "pos", F.col("witness").alias("up")), "merkle-witnesses")
    return _witnessed(rounds[0], above, levels)


def manifest(df: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", keep: list[str] | None = None,
             levels: int = LEVELS, out: str = "merkle") -> DataFrame:
    """``df`` (or its columns ``keep``) plus a struct ``out`` (a column of that name is replaced): leaf, position (in its
    group), witness (steps up to the root), subroot and root."""
    own = carried(df.columns if keep is None else keep, out)
    names = [c for c in (df.columns if keep is None else keep) if c.lower() != out.lower()]
    plain = [f"c{i}" for i in range(len(own))]
    group = F.col(f"`{group_col}`").cast("string")
    grp = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group))  # null first, then bytewise
    leaves = materialize(df.select(grp.alias("grp"), leaf([F.col(f"`{c}`") for c in fields]).alias("digest"), F.col(f"`{id_col}`").alias("_id"),
                                   *[c.alias(p) for c, p in zip(own, plain)]), "merkle-leaves")
    placed = materialize(positions(leaves, ["_id", "digest"]).drop("_id"), "merkle-leaves-placed")
    trees = _rounds(placed, levels)
    tops = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    crown = _rounds(materialize(positions(tops, ["of"]), "merkle-subroots"), levels)
    root = crown[-1].select("grp", "pos", F.array().cast("array<string>").alias("up"), F.col("digest").alias("root"))
    subroots = materialize(_descend(crown, root.select("grp", "pos", "up"), levels).join(root.select("grp", "root"), "grp"), "merkle-crown")
    found = _descend(trees, subroots.select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("witness").alias("up")), levels)
    ends = subroots.select(F.col("of").alias("_of"), F.col("digest").alias("_subroot"), F.col("root").alias("_root"))
    found = found.join(broadcast_checked(ends), F.col("grp") == F.col("_of"))
    return found.select(*[F.col(p).alias(n) for p, n in zip(plain, names)], F.struct(
        F.col("digest").alias("leaf"), F.col("pos").alias("position"), "witness", F.col("_subroot").alias("subroot"), F.col("_root").alias("root")).alias(out))


def siblings(witness: Column) -> Column:
    """The digests of a witness, level by level, concatenated."""
    return F.array_join(F.transform(witness, lambda s: F.substring(s, 2, 64)), "")


def fold(start: Column, witness: Column) -> Column:
    """The root that a leaf and a witness give."""
    def step(acc: Column, s: Column) -> Column:
        side, other = F.substring(s, 1, 1), F.substring(s, 2, 64)
        return F.sha2(F.when(side == "L", F.concat(other, acc)).otherwise(F.concat(acc, other)), 256)
    return F.aggregate(witness, start, step)
