"""The manifest against plain hash trees."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tablekit.llm import merkle, queries
from tablekit.session import scratch_path

DOC = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    values = (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    tiers = [nodes]
    while len(tiers[-1]) > 1:
        tiers.append([digest(*tiers[-1][i:i + 16]) for i in range(0, len(tiers[-1]), 16)])
    return tiers


def path(tiers, i):
    for t in tiers[:-1]:
        p, slot = divmod(i, 16)
        yield slot, t[16 * p:16 * p + 16]
        i = p


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: tree([leaf(r, r["text"]) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order]) if order else []
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(groups[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            value = leaf(r, r["text"].translate(LOW) if changed and r["text"] is not None else r["text"])
            for slot, run in steps:
                value = digest(*run[:slot], value, *run[slot + 1:])
            proof = digest(*(x for slot, run in steps for j, x in enumerate(run) if j != slot))
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return sorted(out, key=repr)


def proved(spark, docs, tiers=merkle.TIERS):
    def hashed(text):
        return merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, hashed(low))
    made = merkle.write_manifest(docs, scratch_path(spark, "manifest"), hashed(F.col("text")), claim=claim, tiers=tiers)
    return sorted((tuple(r) for r in made.prove().collect()), key=repr)


def edge_rows():
    """Nulls in every column, repeated ids and rows, 40 groups of unequal size, a long text."""
    rows = [(i % 7 if i % 11 else None, f"Text É {i % 5}" if i % 13 else None, None if i % 3 else "en",
             None if i % 4 == 0 else f"s{i % 40 if i % 2 else i % 3}", i % 3 or None) for i in range(700)]
    return rows + [(9000, "X" * 300_000, "en", "", 1), (9001, "", "", "é", 0)]


@pytest.mark.parametrize("tiers", [1, 3])
def test_edges_match_brute_force(spark, tiers):
    docs = spark.createDataFrame(edge_rows(), DOC).selectExpr("*", "'x' AS g", "1 AS id", "'y' AS digest", "2 AS rank",
                                                              "'z' AS part", "3 AS total", "'w' AS claim")
    assert proved(spark, docs.repartition(5), tiers) == brute(docs.collect())
    assert proved(spark, docs.limit(0), tiers) == []
    for n in (1, 2, 17):
        few = spark.createDataFrame([(i, "A", None, "s", 1) for i in range(n)], DOC)
        assert proved(spark, few, tiers) == brute(few.collect())


def test_a_hot_group_of_several_rounds(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('T', id) AS text", "'en' AS lang",
                                        "if(id % 4 = 0, concat('s', id % 17), 'hot') AS source", "5L AS n_chars")
    assert proved(spark, docs) == brute(docs.collect())
    assert proved(spark, docs, 1) == brute(docs.collect())


def test_folding_starts_from_the_retained_state():
    nodes = [sha256(i.to_bytes(2)).digest() for i in range(300)]
    t = merkle.Subtree(nodes, 3)
    for i in (0, 15, 16, 299):
        assert t.fold(i, nodes[i].hex().encode()) == t.root
        other = list(nodes)
        other[i] = sha256(b"other").digest()
        assert t.fold(i, other[i].hex().encode()) == merkle.Subtree(other, 3).root != t.root


def test_query(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").collect()
    got = queries.REGISTRY["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs)
