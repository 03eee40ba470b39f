"""N-gram Jaccard join over a count-vector R-tree.

A document's set holds its distinct shingles of ``width`` words, and two are
linked when ``den * intersection >= num * union`` (``Rule``). Shingles are hashed into groups, and the number of shingles per group makes the document a
point; ``sum(min(a_i, b_i))`` bounds the overlap of two documents from above.

A full-dimensional tree cannot prune unrelated documents (their boxes overlap
in nearly every coordinate), so its upper levels split the space instead:

* size slabs, such that partners lie in the same or the next slab;
* in a slab, bands: a pair at the threshold differs in at most ``T`` shingles,
  so of ``T + 1`` bands of groups at least one has equal counts on both sides.
  Documents with the same counts in a band share a tree node (its box is a
  point there).

Below ``BAND_LEAST`` shingles a band (a threshold under about 0.88) unrelated
documents would meet in empty bands. There the nodes are shingles instead: a
document with n shingles shares at least ``num / den * n`` with a partner, so both
hold a common shingle among their first ``n - that + 1`` in any fixed order. The
order puts shingles that many documents hold last; which ones these are is taken
from a sample and changes the nodes only, never the links.

In a node that holds documents not yet linked, a packed R-tree over the full
count vectors is joined with itself: node pairs whose boxes, then points whose
coordinates, bound the overlap too low are dropped. What is left is bounded once
more by a much finer count vector (2 to 4 groups a shingle), of which only the
parities are kept: two sets differ in at least as many shingles as parities.
Pairs that survive both are verified on the shingle sets of the whole texts, so
texts move for pairs that are linked or close to it only.

Nodes are never gathered whole. First every member is compared with the
smallest id of its node (linear in the node), which settles families of copies.
Members left in different components are then joined in tiles of bounded size.

Shingles are compared by a 64-bit hash of their words.

Defined results: null or empty text, or text without words: ``n_shingles`` 0,
linked with nothing, component is the own id. Fewer words than a shingle has:
the whole sequence is the only shingle. Rows with a null id are left out. Equal
sets are linked whatever their order. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, connected_components, fixed_sample, materialize, slices
from .words import BY_SPACE, mix, words

SHINGLE = 3
#: Linked when ``DEN * intersection >= NUM * union``.
NUM, DEN = 90, 100
#: Coordinates of a document's point (more below a threshold of bands, where the
#: bound must tell more apart), and groups within one band.
GROUPS, FINE_GROUPS, BAND_GROUPS = 32, 128, 64
#: Points in a leaf of the packed R-tree, and documents on a side of a tile.
LEAF, TILE = 16, 1024
#: Shingles that a band holds on average, at least; rows of the sample for common
#: shingles, and how many of them hold a common one.
BAND_LEAST, COMMON_ROWS, COMMON = 8, 1000, 10
#: Bytes of parities that are compared at once; ids (16 bytes each) that are sent to
#: every task, above which a merge join takes their place.
PARITY_BYTES, NEAR_IDS = 4 << 20, 1 << 20

_WEIGHT = mix(np.arange(1, BAND_GROUPS + 1, dtype=np.uint64))


@dataclass(frozen=True)
class Rule:
    """Words of a shingle and the threshold ``num / den``."""

    width: int = SHINGLE
    num: int = NUM
    den: int = DEN

    @property
    def banded(self) -> bool:
        return self.num + self.den >= 2 * BAND_LEAST * (self.den - self.num)


    @property
    def groups(self) -> int:
        return GROUPS if self.banded else FINE_GROUPS

    def pack(self, s: np.ndarray) -> bytes:
        """A set's point, low bytes of all coordinates first (the others compress away)."""
        point = np.bincount(s & np.uint64(self.groups - 1), minlength=self.groups).astype("<u4")
        return point.tobytes() if self.banded else point.view(np.uint8).reshape(-1, 4).T.tobytes()

    def near(self, apart: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether sets of ``sizes`` together may be linked if they differ in ``apart`` or more."""
        return apart * (self.den + self.num) <= sizes * (self.den - self.num)

    def unpack(self, points: list[bytes]) -> np.ndarray:
        raw = b"".join(points)
        if self.banded:
            return np.frombuffer(raw, "<u4").reshape(-1, GROUPS)
        planes = np.frombuffer(raw, np.uint8).reshape(-1, 4, FINE_GROUPS)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(-1, FINE_GROUPS)


def shingles(h: np.ndarray, most: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of one document's word hashes."""
    n = len(h)
    if n == 0:
        return h
    width = min(n, most)
    out = np.full(n - width + 1, np.uint64(width))
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:n - width + 1 + k])
    out.sort()
    keep = np.ones(len(out), bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def parities(s: np.ndarray) -> bytes:
    """The parities of a set's counts in 2 to 4 groups a shingle, a power of two, 64 at least."""
    groups = max(64, 1 << (2 * len(s) - 1).bit_length())
    held = np.bincount(((s >> np.uint64(32)) & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return np.packbits((held & 1).astype(bool)).tobytes()


def differing(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """How many parities differ in each pair: at least so many shingles are in one set only.

    The vector of more groups is folded first: a group of the shorter one holds the
    shingles of several, so its parity is theirs together.
    """
    out = np.zeros(len(a), np.int64)
    sizes = np.array([[len(x), len(y)] for x, y in zip(a, b)], np.int64).reshape(-1, 2)
    for la, lb in np.unique(sizes, axis=0).tolist():
        rows = np.flatnonzero((sizes == (la, lb)).all(1))
        for at in range(0, len(rows), max(1, PARITY_BYTES // max(la, lb))):
            part = rows[at:at + max(1, PARITY_BYTES // max(la, lb))]
            x, y = (np.frombuffer(b"".join([v[i] for i in part]), "<u8").reshape(len(part), -1) for v in (a, b))
            least = min(la, lb) // 8
            x, y = (np.bitwise_xor.reduce(v.reshape(len(part), -1, least), axis=1) for v in (x, y))
            out[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def slab_starts(limit: int, num: int = NUM, den: int = DEN) -> list[int]:
    """First sizes of the slabs up to ``limit``, and two beyond."""
    starts = [1]
    while len(starts) < 3 or starts[-3] <= limit:
        starts.append(starts[-1] * den // num + 1)
    return starts


def slab_tables(limit: int, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """Slab starts, and the bands of each slab: one more than the largest difference."""
    starts = np.array(slab_starts(limit, num, den))
    most = starts[1:] - 1
    return starts, (2 * most * (den - num)) // (den + num) + 1


def band_keys(s: np.ndarray, slab: int, bands: int) -> np.ndarray:
    """One key for each band: equal counts in its groups give equal keys."""
    key = np.zeros(bands, np.uint64)
    np.add.at(key, ((s >> np.uint64(24)) % np.uint64(bands)).astype(np.int64),
              _WEIGHT[(s >> np.uint64(8)) & np.uint64(BAND_GROUPS - 1)])
    return mix(key + mix(np.arange(bands, dtype=np.uint64) + np.uint64(slab << 32)))


def prefix_keys(s: np.ndarray, common: np.ndarray, rule: Rule) -> np.ndarray:
    """The first shingles of a sorted set, common ones last: partners share one."""
    n = len(s)
    if n * rule.den < rule.num * (n + 1):  # only equal sets are linked
        return s[:0]
    late = np.isin(s, common, assume_unique=True)
    return np.concatenate([s[~late], s[late]])[:n + rule.num * -n // rule.den + 1]


def common_shingles(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Shingles that ``COMMON`` of about ``COMMON_ROWS`` documents (id, text) hold."""
    def make():
        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(1)):
                hashes, first = words(part, BY_SPACE)
                own = [shingles(hashes[a:b], rule.width) for a, b in zip(first, first[1:])]
                got, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(n)], ["s", "n"])
        return batch
    held = arrow_map(fixed_sample(docs, "id", COMMON_ROWS), make, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
    return held.where(F.col("n") >= COMMON).toPandas()["s"].to_numpy(np.int64).view(np.uint64)


def profiles(docs: DataFrame, id_col: str, text_col: str, rule: Rule = Rule()) -> DataFrame:
    """One row per document: set size, fingerprint, point and node keys."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    common = None if rule.banded else common_shingles(docs, rule)

    def make():
        tables = [slab_tables(1 << 16, rule.num, rule.den)]

        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(1)):
                hashes, first = words(part, BY_SPACE)
                n, low, high, points, odd, keys = [], [], [], [], [], []
                for i in range(len(part)):
                    s = shingles(hashes[first[i]:first[i + 1]], rule.width)
                    n.append(len(s))
                    low.append(int(s.sum(dtype=np.uint64).view(np.int64)))
                    high.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
                    points.append(rule.pack(s))
                    odd.append(parities(s))
                    if not rule.banded:
                        keys.append(prefix_keys(s, common, rule).view(np.int64))
                        continue
                    if len(s) >= tables[0][0][-3]:
                        tables[0] = slab_tables(2 * len(s), rule.num, rule.den)
                    starts, bands = tables[0]
                    k = int(np.searchsorted(starts, len(s), side="right")) - 1
                    own = [band_keys(s, j, int(bands[j])) for j in (k, k + 1)
                           if len(s) and bands[j] > 1]
                    keys.append(np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0)[part.rows], pa.array(n, pa.int64()), pa.array(low, pa.int64()),
                     pa.array(high, pa.int64()), pa.array(points, pa.binary()), pa.array(odd, pa.binary()),
                     pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "n", "f1", "f2", "point", "odd", "keys"])
        return batch
    return arrow_map(docs, make,
                     "id long, n long, f1 long, f2 long, point binary, odd binary, keys array<long>")


def verify(pairs: DataFrame, reps: DataFrame, texts: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The pairs ``(a, b)`` that are linked, checked by bound and then by sets.

    ``reps`` has the points and parities of all documents in pairs. Of ``texts``
    (id, text) only those move whose pairs the bounds have left.
    """
    near = (pairs.join(reps.toDF("a", "na", "pa", "oa"), "a").join(reps.toDF("b", "nb", "pb", "ob"), "b"))

    def bound():
        def batch(rows: pa.RecordBatch):
            if rows.num_rows:
                col = {f: rows.column(i) for i, f in enumerate(rows.schema.names)}
                pa_, pb_ = (rule.unpack(col[c].to_pylist()) for c in ("pa", "pb"))
                size = col["na"].to_numpy() + col["nb"].to_numpy()
                keep = np.minimum(pa_, pb_).sum(1) * (rule.num + rule.den) >= rule.num * size
                left = np.flatnonzero(keep)
                odd = [col[c].take(pa.array(left)).to_pylist() for c in ("oa", "ob")]
                keep[left] = rule.near(differing(*odd), size[left])
                yield pa.RecordBatch.from_arrays([col["a"], col["b"]], ["a", "b"]).filter(pa.array(keep))
        return batch
    near = materialize(arrow_map(near, bound, "a long, b long"), "near")

    def sets():
        kept: dict[int, np.ndarray] = {}

        def of(ident: int, column, i: int) -> np.ndarray:
            if ident not in kept:
                if len(kept) >= 16:
                    kept.pop(next(iter(kept)))
                part = next(slices(column.slice(i, 1)))
                kept[ident] = shingles(words(part, BY_SPACE)[0], rule.width)
            return kept[ident]

        def batch(rows: pa.RecordBatch):
            a, b = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            keep = []
            for i in range(rows.num_rows):
                x, y = of(a[i], rows.column(2), i), of(b[i], rows.column(3), i)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(rule.den * both >= rule.num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(rows.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
        return batch
    wanted = materialize(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "near_ids")
    few = wanted.count() <= NEAR_IDS
    held = materialize(texts.join(F.broadcast(wanted) if few else wanted.hint("merge"), "id", "left_semi")
                       .dropDuplicates(["id"]), "texts")
    full = (near.join(held.toDF("b", "tb"), "b").join(held.toDF("a", "ta"), "a")
            .select("a", "b", "ta", "tb"))
    return materialize(arrow_map(full, sets, "a long, b long"), "links")


def _leaves(n: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """Packed R-tree leaves: by size, then by the first coordinates within a run."""
    order = np.lexsort((points[:, 1], points[:, 0], n))
    return [order[i:i + LEAF] for i in range(0, len(order), LEAF)]


def tree_join(ids, n, comp, points, odd, side, rule: Rule = Rule()) -> tuple[list, list]:
    """Pairs of different components that may reach the threshold by their bounds.

    ``side``: 0 and 1 for the two sides of a tile, 2 if both are the same rows.
    Boxes are compared first, then the points of surviving leaf pairs, then the
    parities of surviving pairs.
    """
    out_a, out_b = [], []
    sides = [np.flatnonzero(side == k) for k in (0, 1)] if (side != 2).any() else None
    if sides is None:
        sides = [np.arange(len(ids))] * 2
    trees = [[rows[leaf] for leaf in _leaves(n[rows], points[rows])] if len(rows) else []
             for rows in sides]
    if not trees[0] or not trees[1]:
        return out_a, out_b
    high = [np.stack([points[leaf].max(0) for leaf in t]) for t in trees]
    least = [np.array([n[leaf].min() for leaf in t]) for t in trees]
    only = [np.array([comp[leaf[0]] if (comp[leaf] == comp[leaf[0]]).all() else -1 for leaf in t])
            for t in trees]
    for i, leaf in enumerate(trees[0]):
        bound = np.minimum(high[0][i], high[1]).sum(1) * (rule.num + rule.den)
        live = (bound >= rule.num * (least[0][i] + least[1])) & ((only[0][i] == -1) | (only[0][i] != only[1]))
        if trees[0] is trees[1] or sides[0] is sides[1]:
            live[:i] = False
        picked = np.flatnonzero(live)
        if not len(picked):
            continue
        other = np.concatenate([trees[1][j] for j in picked])
        over = np.minimum(points[leaf][:, None, :], points[other][None, :, :]).sum(2) * (rule.num + rule.den)
        ok = ((over >= rule.num * (n[leaf][:, None] + n[other][None, :]))
              & (comp[leaf][:, None] != comp[other][None, :]))
        x, y = np.nonzero(ok)
        apart = differing([odd[i] for i in leaf[x]], [odd[i] for i in other[y]])
        close = rule.near(apart, n[leaf[x]] + n[other[y]])
        x, y = x[close], y[close]
        out_a.append(np.minimum(ids[leaf[x]], ids[other[y]]))
        out_b.append(np.maximum(ids[leaf[x]], ids[other[y]]))
    return out_a, out_b


def cross_pairs(members: DataFrame, reps: DataFrame, comps: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Candidate pairs in nodes whose members lie in different components."""
    rows = (members.select("key", "id").join(comps, "id", "left")
            .select("key", "id", F.coalesce("component", "id").alias("component")))
    mixed = (rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                     F.count("*").alias("m"))
             .where("x <> y").select("key", F.ceil(F.col("m") / TILE).alias("parts")))
    rows = (rows.join(mixed, "key").join(reps, "id")
            .withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       F.when(F.col("own") == F.col("other"), 2)
                       .when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
                       "id", "n", "component", "point", "odd")

    def node(table: pa.Table) -> pa.Table:
        points = rule.unpack(table["point"].to_pylist())
        a, b = tree_join(*(table[c].to_numpy() for c in ("id", "n", "component")),
                         points.astype(np.int32), table["odd"].to_pylist(), table["side"].to_numpy(), rule)
        pick = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
        return pa.table(pick, names=["a", "b"])
    return rows.groupBy("key", "i", "j").applyInArrow(node, "a long, b long").where("a < b").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                       width: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for every row with an id.

    Shingles have ``width`` words; linked at a similarity of ``num / den`` or more.
    """
    rule = Rule(width, num, den)
    prof = materialize(profiles(docs, id_col, text_col, rule), "profiles")
    same = ["n", "f1", "f2"]
    first = prof.where("n > 0").groupBy(*same).agg(F.min("id").alias("rep"))
    owner = materialize(prof.select("id", *same).join(first, same, "left")
                        .select("id", "n", F.coalesce("rep", "id").alias("rep")), "owners")
    sigs = prof.select("id", F.explode("keys").alias("key"))
    nodes = (sigs.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
             .where("low <> high").select("key"))
    # Members of nodes, copies replaced by their representative.
    rows = materialize(sigs.join(nodes.hint("merge"), "key")
                       .join(owner.select("id", "rep").distinct().hint("merge"), "id")
                       .select("key", F.col("rep").alias("id")).distinct(), "members")
    ends = rows.groupBy("key").agg(F.min("id").alias("rep"), F.max("id").alias("last")).where("rep <> last")
    members = materialize(rows.join(ends.select("key", "rep"), "key"), "members")
    # Points of the members alone; a merge join, as neither side has a bound.
    wanted = materialize(members.select("id").distinct(), "wanted")
    reps = materialize(prof.select("id", "n", "point", "odd").join(wanted.hint("merge"), "id", "left_semi")
                       .dropDuplicates(["id"]), "points")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    star = members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")).distinct()
    links = verify(star, reps, texts, rule)
    comps = connected_components(links)
    more = verify(cross_pairs(members, reps, comps, rule), reps, texts, rule)
    comps = connected_components(links.unionByName(more)).withColumnRenamed("id", "rep")
    return owner.join(comps, "rep", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"))
