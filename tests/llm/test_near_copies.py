"""The pipeline's near-copy stage against a five-word, 0.8 brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablekit.llm import ngram_jaccard, queries
from tablekit.llm.ngram_jaccard import jaccard_components

SF = "/root/testdata/sf0.01"


def brute(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + width]) for k in range(max(len(w) - width, 0) + 1)} if w else set()
    comp = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and den * min(len(x), len(y)) >= num * max(len(x), len(y)):
            both = len(x & y)
            if den * both >= num * (len(x) + len(y) - both) and comp[a] != comp[b]:
                low, high = sorted((comp[a], comp[b]))
                comp = {i: low if c == high else c for i, c in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in sets}


def families():
    """Chains of near copies around 0.8, texts of 1 to 400 words, and a line that all others share."""
    rng, rows = np.random.default_rng(15), []
    line = [f"c{i}" for i in range(12)]
    for size in (1, 4, 5, 6, 8, 9, 12, 25, 50, 120, 400):
        words = [f"w{rng.integers(0, 10**6)}" for _ in range(size)]
        for _ in range(12):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(int(rng.integers(0, 2 + size // 40))):
                words[rng.integers(0, len(words))] = f"v{rng.integers(0, 10**6)}"
    for _ in range(60):
        own = [f"u{rng.integers(0, 10**6)}" for _ in range(int(rng.integers(3, 60)))]
        rows.append((len(rows), " ".join(own + line)))
    return rows


@pytest.mark.parametrize("width,num,den,common", [(5, 80, 100, 10), (5, 80, 100, 10**9), (5, 50, 100, 2), (3, 90, 100, 10),
                                                  (2, 95, 100, 10)])
def test_rules_match_brute_force(spark, monkeypatch, width, num, den, common):
    monkeypatch.setattr(ngram_jaccard, "COMMON", common)
    rows = families()
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), width=width, num=num, den=den)
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == brute(rows, width, num, den)


def test_stage_removes_five_word_near_copies(spark):
    base = [f"w{i}" for i in range(100)]
    near = [*base[:30], "x", *base[31:70], "y", *base[71:]]   # 86 of 106 shingles: 0.81
    far = [w if i % 33 else "z" for i, w in enumerate(base)]  # 78 of 114 shingles
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate((base, near, far))], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.dedup(spark, frame, SF).collect()} == {0, 2}
    docs = queries.table(spark, SF, "documents")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80, 100)
    kept = {r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, SF).select("doc_id").collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for n, m, both in ((1, 1, 0), (5, 3, 3), (40, 45, 38), (500, 2000, 450), (3000, 2900, 2890), (70_000, 100, 100)):
        pool = np.unique(rng.integers(0, 1 << 64, n + m + 64, dtype=np.uint64))[:n + m - both]
        rng.shuffle(pool)
        a, b = np.sort(pool[:n]), np.sort(pool[n - both:])
        x, y = ngram_jaccard.parities(a), ngram_jaccard.parities(b)
        found = ngram_jaccard.differing([x, y, x], [y, x, x])
        apart = len(a) + len(b) - 2 * both
        assert found[0] == found[1] <= apart and found[2] == 0
        assert apart > len(a) / 10 or found[0] > 0.7 * apart  # close to it where it decides
    assert len(ngram_jaccard.differing([], [])) == 0


def test_unlinked_documents_of_one_base_are_no_candidates(spark):
    """Documents around a common base, below the threshold: few leave the tiles."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(300)]

    def member():
        words = list(base)
        for at in rng.choice(300, 12, replace=False):  # each spoils five shingles
            words[at] = f"x{rng.integers(0, 10**9)}"
        return " ".join(words)
    counts = []
    for size in (100, 400):
        docs = spark.createDataFrame([(i, member()) for i in range(size)], "doc_id long, text string")
        rule = ngram_jaccard.Rule(5, 80, 100)
        prof = ngram_jaccard.profiles(docs, "doc_id", "text", rule).cache()
        members = prof.select(F.explode("keys").alias("key"), "id")
        comps = spark.createDataFrame([], "id long, component long")
        reps = prof.select("id", "n", "point", "odd")
        counts.append(ngram_jaccard.cross_pairs(members, reps, comps, rule).count())
        assert jaccard_components(docs, width=5, num=80, den=100).select("component_id").distinct().count() == size
    assert counts[1] <= 400 * 0.05, counts
