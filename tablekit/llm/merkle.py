"""Merkle manifest of a table: a hash tree per group and one over the groups.

A row's leaf is the SHA-256 of its columns. Per group the leaves are in ascending
id order, and runs of 16 nodes become their parent, tier by tier, until one node,
the subroot, remains; the subroots, ordered by group, likewise give the root.

A parent is hashed child by child, and a copy of the hash state is retained
before each child. To fold a changed child upwards, its state is resumed with the
replacement and the siblings to its right only: nothing left of it is hashed
again.

At scale: a group's leaves are numbered over a range partitioning, so a group
may be as large as the table. 16^3 consecutive nodes are a block, one row: a
subtree of three tiers that one task hashes; the blocks' roots are the nodes of
the next round. On the way back each round hands its children the path above them, so a
leaf block has all its siblings up to the root: one row joined with one row.

Defined results: rows without a group form the first group, rows without an id
come first in theirs; rows with equal ids are ordered by their leaf. Each row is
a leaf of its own, also repeated ones. An empty table has no root and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import arrow_map

#: Children of a parent, tiers of a block (of ``FAN ** TIERS`` nodes).
FAN, TIERS = 16, 3

PATH = "slots array<int>, runs array<binary>, subroot binary, root binary"


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the columns: each ``-`` if null, else its UTF-8 byte count, ``:`` and value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")),
                        F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tiers_of(nodes: int, most: int) -> int:
    """Tiers that a block adds above its group's nodes of a round."""
    k = 0
    while nodes > 1 and k < most:
        nodes, k = -(-nodes // FAN), k + 1
    return k


class Subtree:
    """Tiers over some nodes, with the hash state before each child retained.

    Digests are hexadecimal text; ``runs[t][p]`` are the joined children of parent
    ``p`` and ``states[t][i]`` is the state before child ``i``.
    """

    def __init__(self, digests: list[bytes], tiers: int):
        nodes = [d.hex().encode() for d in digests]
        self.nodes, self.states, self.runs = nodes, [], []
        for _ in range(tiers):
            states, runs, parents = [], [], []
            for at in range(0, len(nodes), FAN):
                state = sha256()
                for child in nodes[at:at + FAN]:
                    states.append(state.copy())
                    state.update(child)
                runs.append(b"".join(nodes[at:at + FAN]))
                parents.append(state.hexdigest().encode())
            self.states.append(states)
            self.runs.append(runs)
            nodes = parents
        self.root = nodes[0]

    def path(self, i: int) -> list[tuple[int, bytes]]:
        """Node ``i``'s slot among its parent's children, and these, tier by tier."""
        out = []
        for runs in self.runs:
            i, slot = divmod(i, FAN)
            out.append((slot, runs[i]))
        return out

    def fold(self, i: int, value: bytes) -> bytes:
        """The subtree's root with ``value`` in place of node ``i``."""
        for states, runs in zip(self.states, self.runs):
            state = states[i].copy()
            i, slot = divmod(i, FAN)
            state.update(value + runs[i][64 * (slot + 1):])
            value = state.hexdigest().encode()
        return value


class Above:
    """The path from a subtree's root to the root, with its states retained."""

    def __init__(self, slots: list[int], runs: list[bytes]):
        self.steps = [(sha256(r[:64 * s]), r[64 * (s + 1):]) for s, r in zip(slots, runs)]
        self.siblings = b"".join(others(s, r) for s, r in zip(slots, runs))

    def fold(self, value: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(value + right)
            value = state.hexdigest().encode()
        return value


def others(slot: int, run: bytes) -> bytes:
    return run[:64 * slot] + run[64 * (slot + 1):]


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """``rows`` with ``rank``, the place in its group ``g`` (from 0), and ``total``, the group's rows.

    Rows are dealt by ranges of (g, order), so a large group is spread; what is
    counted before a task's rows comes from one row per group and task.
    """
    placed = _write(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                    .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
                    f"{path}/placed")
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = _write(runs.select("g", "part", (F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("base"),
                              F.sum("n").over(Window.partitionBy("g")).alias("total")), f"{path}/runs")
    return placed.join(runs, ["g", "part"]).withColumn("rank", F.col("at") - F.col("base")).drop("part", "at", "base")


def _blocks(nodes: DataFrame, keep: list[str], path: str, tiers: int) -> DataFrame:
    """One row per group and block of consecutive nodes: ``digest`` and ``keep`` as arrays."""
    rows = nodes.groupBy("g", F.expr(f"rank div {FAN ** tiers}").alias("block")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("rank", "digest", *keep))).alias("x"))
    return _write(rows.select("g", "block", "total", *[F.col(f"x.{c}").alias(c) for c in ["digest", *keep]]), path)


def _roots(blocks: DataFrame, tiers: int) -> DataFrame:
    """The nodes of the next round: each block's root."""
    def make():
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            root = [bytes.fromhex(Subtree(d, tiers_of(t, tiers)).root.decode())
                    for d, t in zip(rows.column("digest").to_pylist(), rows.column("total").to_pylist())]
            total = [-(-t // FAN ** tiers) for t in rows.column("total").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("g"), rows.column("block"), pa.array(total, pa.int64()), pa.array(root, pa.binary())],
                ["g", "rank", "total", "digest"])
        return batch
    return arrow_map(blocks.select("g", "block", "total", "digest"), make,
                     "g string, rank long, total long, digest binary")


def _tree(blocks: DataFrame, path: str, tiers: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks from the first one, and ``(g, digest, round)`` of each group's root.

    The number of rounds is the logarithm of the largest group to the base of a block's nodes.
    """
    rounds, done = [blocks], None
    while True:
        k = len(rounds) - 1
        roots = _write(_roots(rounds[-1], tiers), f"{path}/roots_{k}")
        ended = roots.where("total = 1").select("g", "digest", F.lit(k).alias("round"))
        done = ended if done is None else done.unionByName(ended)
        more = roots.where("total > 1")
        if more.isEmpty():
            return rounds, done
        rounds.append(_blocks(more, [], f"{path}/blocks_{k + 1}", tiers))


def _hand_down(blocks: DataFrame, above: DataFrame, key: str, tiers: int) -> DataFrame:
    """The path of every node of ``blocks``: its own tiers, then those above its block.

    ``key`` names a node in the result: its rank as ``block`` of the round before, or
    a column of names.
    """
    name, kind = ("g", "g string") if key != "block" else ("block", "g string, block long")

    def make():
        def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for r in rows.to_pylist():
                tree = Subtree(r["digest"], tiers_of(r["total"], tiers))
                for at in range(0, len(tree.nodes), 256):
                    part = range(at, min(at + 256, len(tree.nodes)))
                    paths = [tree.path(i) for i in part]
                    names = [r["block"] * FAN ** tiers + i for i in part] if key == "block" else r[key][at:at + 256]
                    own = [pa.array([r["g"]] * len(part), pa.string())] if key == "block" else []
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(names, pa.int64() if key == "block" else pa.string()),
                         pa.array([[s for s, _ in p] + r["slots"] for p in paths], pa.list_(pa.int32())),
                         pa.array([[x for _, x in p] + r["runs"] for p in paths], pa.list_(pa.binary())),
                         # A named node of the tree over groups is a subroot itself.
                         pa.array([r["subroot"] if key == "block" else r["digest"][i] for i in part], pa.binary()),
                         pa.array([r["root"]] * len(part), pa.binary())],
                        (["g", name] if key == "block" else [name]) + ["slots", "runs", "subroot", "root"])
        return batch
    both = blocks.join(above, ["g", "block"])
    return arrow_map(both, make, f"{kind}, {PATH}")


class Manifest:
    """A manifest's tables under ``path``; ``prove`` gives every row's proof."""

    def __init__(self, spark: SparkSession, path: str, rounds: list[DataFrame], subroots: DataFrame,
                 top: list[DataFrame], root: DataFrame, tiers: int):
        self.spark, self.path, self.tiers = spark, path, tiers
        #: Blocks by round over the leaves, and over the subroots.
        self.rounds, self.top = rounds, top
        #: ``(g, digest, round)`` per group, and the root as ``(g, digest, round)``: one row.
        self.subroots, self.root = subroots, root

    def _paths(self) -> DataFrame:
        """``(g, block, PATH)`` of every leaf block."""
        none = [F.array().cast("array<int>").alias("slots"), F.array().cast("array<binary>").alias("runs")]
        above = self.root.select("g", F.lit(0).cast("long").alias("block"), *none,
                                 F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
        for blocks in self.top[:0:-1]:
            above = _hand_down(blocks, above, "block", self.tiers)
        named = _hand_down(self.top[0], above, "name", self.tiers)
        named = _write(named.withColumnRenamed("g", "name").join(
            self.subroots.select(F.col("g").alias("name"), "round"), "name")
            .select(F.col("name").alias("g"), F.lit(0).cast("long").alias("block"), "round", *_names(PATH)),
            f"{self.path}/paths")
        above = None
        for k in range(len(self.rounds) - 1, -1, -1):
            start = named.where(F.col("round") == k).drop("round")
            above = start if above is None else _hand_down(self.rounds[k + 1], above, "block", self.tiers) \
                .unionByName(start)
        return above

    def prove(self) -> DataFrame:
        """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row, in hexadecimal.

        ``proof_sha256`` hashes the row's siblings from its leaf to the root;
        ``folded_root`` folds the row's claimed digest with them.
        """
        tiers = self.tiers

        def make():
            def batch(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                for r in rows.to_pylist():
                    tree, above = Subtree(r["digest"], tiers_of(r["total"], tiers)), Above(r["slots"], r["runs"])
                    root, subroot = r["root"].hex(), r["subroot"].hex()
                    proof, folded = [], []
                    for i, claim in enumerate(r["claim"]):
                        siblings = sha256(b"".join(others(s, x) for s, x in tree.path(i)))
                        siblings.update(above.siblings)
                        proof.append(siblings.hexdigest())
                        folded.append(above.fold(tree.fold(i, claim.hex().encode())).decode())
                    n = len(proof)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r["id"], pa.int64()), pa.array([x.decode() for x in tree.nodes]),
                         pa.array([subroot] * n), pa.array([root] * n), pa.array(proof), pa.array(folded),
                         pa.array([f == root for f in folded])],
                        ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
            return batch
        return arrow_map(self.rounds[0].join(self._paths(), ["g", "block"]), make,
                         "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                         "verified boolean")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def write_manifest(rows: DataFrame, path: str, digest: Column, group_col: str = "source", id_col: str = "doc_id",
                   claim: Column | None = None, tiers: int = TIERS) -> Manifest:
    """Build the manifest of ``rows`` under ``path``; blocks of ``tiers`` tiers.

    ``digest`` is a row's leaf (32 bytes, as of ``leaf_digest``), ``claim`` the digest
    that ``prove`` folds in its place (null or not given: the leaf).
    """
    # '' comes before all other names: rows without a group are the first group.
    name = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = rows.select(name.alias("g"), F.col(id_col).cast("bigint").alias("id"), digest.alias("digest"),
                         (F.lit(None).cast("binary") if claim is None else claim).alias("claim"),
                         F.monotonically_increasing_id().alias("nth"))
    # Read texts once: the ranges of the sort are found in the written digests.
    leaves = _write(leaves, f"{path}/leaves").withColumn("claim", F.coalesce("claim", "digest"))
    leaves = _numbered(leaves, ["id", "digest", "nth"], path)
    rounds, subroots = _tree(_blocks(leaves, ["id", "claim"], f"{path}/blocks_0", tiers), path, tiers)
    names = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    path_top = f"{path}/top"
    names = _numbered(names, ["name"], path_top)
    top, root = _tree(_blocks(names, ["name"], f"{path_top}/blocks_0", tiers), path_top, tiers)
    return Manifest(rows.sparkSession, path, rounds, subroots, top, root, tiers)
