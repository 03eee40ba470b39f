"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Each unit vector u is stored as ``s * q`` with int8 ``q``. With the exact
residual norm ``e = |u - s q|`` every cosine obeys
``u.v <= s_u s_v (q_u . q_v) + e_u + |s_u q_u| e_v``; pairs whose bound is
below the threshold cannot be links. All others are recomputed in double
precision from the original components. Integer products are exact in the
float type that the matrix product uses.

Equal vectors are one representative with a count. Representatives are dealt
into hash blocks of about ``BLOCK`` vectors and every pair of blocks is one
tile; a tile returns, for each of its vectors, the number of links and one edge
of a spanning forest, never the pairs, so a group of copies costs rows in
proportion to its size. The number of tiles grows with the square of the
number of distinct vectors.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite components links with nothing (``n_links`` 0, own component).
Vectors of different lengths never link. Rows with a null id are left out;
repeated rows of one id are one vector. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import connected_components, materialize

THRESHOLD = 0.9
#: Vectors on a side of a tile, and rows of one matrix product inside it.
BLOCK, STRIPE = 4096, 1024
#: Above this length products of int8 need more than 24 bits.
_SINGLE = (1 << 24) // (127 * 127)
#: Slack for the rounding of the bounds themselves.
_EPS = 1e-9


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, such that squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    return np.ldexp(vectors, -exponent[:, None])


def quantise(vectors: np.ndarray):
    """``(q, s, e, m)`` of unit vectors: int8 codes, step, residual norm, norm of s*q."""
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    unit = vectors / norm[:, None]
    s = np.abs(unit).max(1) / 127.0
    q = np.rint(unit / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.sqrt(((unit - back) ** 2).sum(1)), np.sqrt((back ** 2).sum(1)), norm


def tile_links(x: np.ndarray, y: np.ndarray, same: bool, threshold: float):
    """Yields index arrays ``(i, j)`` of linked rows of x and y; i < j if ``same``."""
    x = scaled(x)
    y = x if same else scaled(y)
    qx, sx, ex, mx, nx = quantise(x)
    qy, sy, ey, my, ny = (qx, sx, ex, mx, nx) if same else quantise(y)
    kind = np.float32 if x.shape[1] <= _SINGLE else np.float64
    left, right = qx.astype(kind), np.ascontiguousarray(qy.astype(kind).T)
    # One bound per row with the block's largest step and residual; exact bounds follow.
    floor = (threshold - _EPS - ex - mx * ey.max()) / (sx * sy.max())
    for a in range(0, len(x), STRIPE):
        b = min(a + STRIPE, len(x))
        product = left[a:b] @ right
        i, j = np.divmod(np.flatnonzero(product >= np.minimum(floor[a:b, None], np.float64(1 << 40)).astype(kind) - 1),
                         len(y))
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        bound = sx[i] * sy[j] * product[i - a, j] + ex[i] + mx[i] * ey[j]
        i, j = i[bound >= threshold - _EPS], j[bound >= threshold - _EPS]
        for k in range(0, len(i), 1 << 18):  # full precision
            p, r = i[k:k + (1 << 18)], j[k:k + (1 << 18)]
            ok = np.einsum("ij,ij->i", x[p], y[r]) / (nx[p] * ny[r]) >= threshold
            yield p[ok], r[ok]


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions the smallest label of their set, in place."""
    while len(a):
        low = np.minimum(label[a], label[b])
        moved = (label[a] != low) | (label[b] != low)
        if not moved.any():
            return
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label[:] = label[label]


def tile(ids: np.ndarray, mult: np.ndarray, vectors: np.ndarray, side: np.ndarray, threshold: float):
    """``(id, links, near)``: counted links and a forest edge for each vector of a tile."""
    order = np.argsort(ids, kind="stable")
    ids, mult, vectors, side = ids[order], mult[order], vectors[order], side[order]
    rows = [np.arange(len(ids))] * 2 if (side == 2).all() else [np.flatnonzero(side == k) for k in (0, 1)]
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    if len(rows[0]) and len(rows[1]):
        same = rows[0] is rows[1]
        for i, j in tile_links(vectors[rows[0]], vectors[rows[1]], same, threshold):
            a, b = rows[0][i], rows[1][j]
            np.add.at(links, a, mult[b])
            np.add.at(links, b, mult[a])
            _join_labels(label, a, b)
    hit = links > 0
    return ids[hit], links[hit], ids[label[hit]]


def embedding_links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every id."""
    rows = (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where("id is not null").dropDuplicates(["id"]))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    zero = ~F.exists("v", lambda c: c != 0)
    rows = rows.withColumn("v", F.when(F.col("v").isNotNull() & ~bad & ~zero, F.col("v")))
    rows = materialize(rows, "vectors")
    valid = rows.where("v is not null")
    reps = materialize(valid.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("mult")), "reps")
    owner = materialize(valid.join(reps, "v").select("id", "rep", "mult"), "owners")

    parts = -(-reps.count() // BLOCK)
    dealt = (reps.select(F.col("rep").alias("id"), "mult", "v", F.size("v").alias("dim"),
                         F.pmod(F.xxhash64("rep"), F.lit(max(parts, 1))).alias("own"))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(parts, 1) - 1).cast("bigint"))))
             .select("dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0)
                     .otherwise(1).alias("side"), "id", "mult", "v"))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table["v"].chunks])
        ids, links, near = tile(table["id"].to_numpy(), table["mult"].to_numpy(),
                                flat.reshape(table.num_rows, -1), table["side"].to_numpy(), threshold)
        return pa.table([ids, links, near], names=["id", "links", "near"])
    tiles = materialize(dealt.groupBy("dim", "i", "j").applyInArrow(run, "id long, links long, near long"), "tiles")
    comps = connected_components(tiles.where("id <> near"), "id", "near")
    counts = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    found = (owner.join(counts.withColumnRenamed("id", "rep"), "rep", "left")
             .join(comps.withColumnRenamed("id", "rep"), "rep", "left")
             .select("id", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return (rows.select("id").join(found, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"),
                    (F.coalesce("component_id", "id") == F.col("id")).alias("kept")))
