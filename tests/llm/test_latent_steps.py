"""Kept terms, sums by runs and the last step's products of decontamination."""

from __future__ import annotations

import numpy as np

from tablekit.llm import decontaminate, words
from tablekit.llm.base import Texts


def test_spread_sums_of_frequent_and_rare_terms():
    rng = np.random.default_rng(1)
    for n in (0, 1, 31, 32, 33, 5000):
        t = np.where(rng.random(n) < 0.5, 7, rng.integers(0, 40, n)).astype(np.uint16)
        at, values = rng.integers(0, 60, n), rng.integers(0, 9, (60, 5)).astype(np.float32)
        out, want = np.ones((40, 5), np.float32), np.ones((40, 5), np.float32)
        decontaminate._spread_sums(out, t, at, values)
        np.add.at(want, t, values[at])
        assert np.array_equal(out, want)


def test_kept_terms_give_frequencies_and_the_latent_space(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [None, ""] + [" ".join(f"w{i}" for i in rng.integers(0, 300, n)) for n in rng.integers(1, 150, 60)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string")
    kept = decontaminate.term_table(docs)
    assert kept.agg({"chars": "sum"}).first()[0] == sum(len(x or "") for x in texts)
    data = [x.encode() for x in texts if x]
    offs = np.cumsum([0, *map(len, data)])
    h, first = words.words(Texts(np.frombuffer(b"".join(data), np.uint8), offs, slice(0, len(data))), words.BY_LETTER, True)
    t, want = decontaminate.term(h), np.zeros(decontaminate.TERMS)
    for a, b in zip(first, first[1:]):
        want[np.unique(t[a:b])] += 1
    df, total = decontaminate.document_frequencies(kept.select("terms"))
    assert total == len(texts) and np.array_equal(df, want)

    monkeypatch.setattr(decontaminate, "RANK", 8)
    idf = np.log((1 + total) / (1 + df)) + 0.05
    text, start, stop = decontaminate._windows(first)
    dense = np.zeros((len(start), decontaminate.TERMS))
    row, own, w = decontaminate._tfidf_rows(h, idf, start, stop)
    np.add.at(dense, (row, own), w)
    dense = dense[:, want > 0]
    # The passages' norm counts each word by itself, as the operator's does.
    basis = decontaminate.randomised_svd(kept.selectExpr("terms", "1D as weight"), idf)[want > 0]
    assert np.allclose(basis.T @ basis, np.eye(8), atol=2e-2)
    got, best = np.linalg.norm(dense @ basis) ** 2, (np.linalg.svd(dense, compute_uv=False)[:8] ** 2).sum()
    assert 0.9 * best <= got <= best * 1.01
