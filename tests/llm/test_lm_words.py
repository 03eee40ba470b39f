"""The language models keep every word, whatever its rank."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekit.llm import lm_score


def test_rare_words_have_losses_of_their_own(spark):
    """70,000 words of one corpus; the rarest are contexts and predictions like any other."""
    rng = np.random.default_rng(4)
    names = [f"r{i}" for i in range(70_000)]
    order = rng.permutation(len(names))
    rare = [" ".join(names[i] for i in order[a:a + 100]) for a in range(0, len(names), 100)]
    often = " ".join(f"{names[i]} {names[i]}" for i in range(66_000))
    twin = "solo follows"                             # each occurs once, in the target only
    frame = lambda t: spark.createDataFrame([(x,) for x in t], "text string").repartition(4)
    background, target = [*rare, often, twin], [twin]
    docs = spark.createDataFrame([(1, twin), (2, "solo r1"), (4, twin), (4, twin)], "doc_id long, text string")
    models = lm_score.fit(frame(background), frame(target))
    got = {r["doc_id"]: r for r in lm_score.score(models, docs, "doc_id", "text").collect()}
    words = [t.split() for t in background]
    size, total = len({w for t in words for w in t}), sum(map(len, words))
    cells = lm_score.ALPHA * (size + 1)

    def want(first, last):  # mean loss of two words, after the start mark and after 'solo'
        return -(np.log(first) + np.log(last)) / 2
    one = (1 + lm_score.ALPHA) / (2 + cells)          # 'solo' and 'follows' in the target
    target_loss = want((1 + one) / 2, (1 + one) / 2)
    single = (1 + lm_score.ALPHA) / (total + cells)   # and in the background
    starts = len(background)
    heads = len({t[0] for t in words})
    background_loss = want((1 + heads * single) / (starts + heads), (1 + single) / 2)
    assert (got[1]["target_loss"], got[1]["background_loss"]) == pytest.approx((target_loss, background_loss), rel=1e-9)
    assert got[1]["score"] < got[2]["score"]
    assert got[1]["n_tokens"] == got[4]["n_tokens"] == 2 and got[1]["score"] == pytest.approx(got[4]["score"])


@pytest.mark.parametrize("size", [500, 1500])
def test_one_formula_for_every_vocabulary(spark, size):
    """No number of words is a switch: a text of unseen words loses ln(size + 1) a word."""
    frame = lambda t: spark.createDataFrame([(x,) for x in t], "text string")
    corpus = [" ".join(f"v{i}" for i in range(size))]
    docs = spark.createDataFrame([(1, "new words only")], "doc_id long, text string")
    got = lm_score.score(lm_score.fit(frame(corpus), frame([])), docs, "doc_id", "text").first()
    assert got["target_loss"] == pytest.approx(np.log(size + 1), rel=1e-9)
    alone = lm_score.ALPHA / (size + lm_score.ALPHA * (size + 1))
    first = np.log((1 + 1) / alone)  # after the start mark, which one word follows
    assert got["background_loss"] == pytest.approx((first - 2 * np.log(alone)) / 3, rel=1e-9)


def test_shards_and_chunks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 60, rng.integers(0, 90))), bool(i % 3)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")

    def run(parts):
        out = lm_score.score_texts(docs.repartition(parts), "doc_id", "text", F.col("good"), F.lit(True), F.lit(True))
        return {r["doc_id"]: (r["n_tokens"], round(r["target_loss"], 9), round(r["background_loss"], 9)) for r in out.collect()}
    whole = run(1)
    monkeypatch.setattr(lm_score, "SHARD_PAIRS", 50)
    assert run(9) == whole and len(whole) == 120
