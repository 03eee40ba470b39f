"""Benchmark items cut before their end."""

from __future__ import annotations

import numpy as np

from tablekit.llm.decontaminate import contaminated


def test_cut_items_are_found_and_scattered_ones_need_the_answer(spark):
    rng = np.random.default_rng(3)
    def text(n):
        return [f"t{rng.integers(0, 4000)}" for _ in range(n)]
    items = {i: text(59) for i in range(6)}
    docs, want = [], set()
    for i, item in items.items():
        gaps = [w for k, w in enumerate(item[:54]) if k % 12]                       # nearly contiguous
        spread = [x for k, w in enumerate(item[:50]) for x in ([w] if k % 5 else text(4))]  # scattered, no answer
        answered = [x for k, w in enumerate(item) for x in ([w] if k % 5 or k > 50 else text(4))]
        for kind, (words, found) in enumerate(((item[:54], 1), (item[:51], 1), (item[8:], 1), (gaps, 1), (item[:40], 1),
                                               (item[:30], 0), (spread, 0), (answered, 1))):
            docs.append((10 * i + kind, " ".join(text(90) + words + text(70))))
            want |= {(10 * i + kind, i)} if found else set()
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want
