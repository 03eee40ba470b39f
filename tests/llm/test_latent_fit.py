"""The latent space is fitted on all documents, and paraphrases at the limit are found."""

from __future__ import annotations

import numpy as np

from tablekit.llm import decontaminate, queries

SF = "/root/testdata/sf0.01"


def test_all_documents_are_fitted_and_paraphrases_found(spark, monkeypatch):
    docs, bench = (queries.table(spark, SF, t) for t in ("documents", "benchmark"))
    items = [(r["item_id"], r["text"].split()) for r in bench.collect() if r["text"]]
    rng, rows = np.random.default_rng(0), []
    hosts = [r["text"].split() for r in docs.limit(200).collect() if r["text"]]
    for k in range(100):  # 62 % of the words and the whole end are kept
        item, w = items[k % len(items)]
        kept = set(rng.choice(len(w) - 8, int(np.ceil(0.62 * len(w))) - 8, replace=False)) | set(range(len(w) - 8, len(w)))
        host = hosts[rng.integers(len(hosts))]
        other = [x for h in rng.choice(len(hosts), 3) for x in hosts[h]]
        new = [x if j in kept else other[rng.integers(len(other))] for j, x in enumerate(w)]
        rows.append((10**7 + k, " ".join(host[:40] + new + host[40:]), item))
    whole = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"))
    fitted, svd = [], decontaminate.randomised_svd
    monkeypatch.setattr(decontaminate, "randomised_svd", lambda d, idf: (fitted.append(d.count()), svd(d, idf))[1])
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(whole, bench).collect()}
    assert fitted == [whole.where("doc_id is not null").count() + len(items)]
    assert sum((i, item) in got for i, _, item in rows) >= 98
