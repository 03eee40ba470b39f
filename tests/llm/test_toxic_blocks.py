"""The toxicity model is fitted on every labelled row, in blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tablekit.llm import queries, toxicity

COLS = ("text", "toxic", "lang", "doc_id")


def labelled_rows(spark, n):
    """Every fifth row is toxic by its words; 40 rows have a language of their own."""
    x = F.col("doc_id")
    words = F.concat_ws(" ", *(F.concat(F.lit("w"), (x * k) % 97) for k in (3, 7, 11, 13)))
    return (spark.range(n).withColumnRenamed("id", "doc_id").select(
        "doc_id", F.when(x % 5 == 0, F.concat(words, F.lit(" vile"), (x % 3).cast("string"), F.lit(" end"))).otherwise(words).alias("text"),
        F.when(x % (n // 40) == 7, F.concat(F.lit("l"), x)).otherwise("en").alias("lang"), (x % 5 == 0).cast("int").alias("toxic")))


def test_every_labelled_row_is_learned_from(spark):
    rows = labelled_rows(spark, 20_000)
    model = toxicity.fit(rows, *COLS)
    assert len(model.langs) == 41  # each of the 40 languages is that of one row
    got = toxicity.predict(model, rows, "doc_id", "text", [F.col("toxic")])
    assert got.count() == 20_000 and got.where("predicted <> toxic").count() == 0


def test_labels_are_not_sampled(spark, monkeypatch):
    labels = spark.range(30_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    docs = labels.selectExpr("doc_id", "'a text' AS text", "'en' AS lang")
    kept = labels.where(f"crc32(cast(doc_id AS string)) % {queries.TOXIC_FOLDS} <> {queries.TOXIC_HELD_OUT}").count()
    for most in (queries.LABEL_ROWS, 0):  # labels sent to every task, and too many for that
        monkeypatch.setattr(queries, "LABEL_ROWS", most)
        assert queries.labelled(docs, labels).count() == kept > 20_000


def test_blocks_hold_every_row_and_hold_out_one_in_four(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 150)
    monkeypatch.setattr(toxicity, "SCORE_BYTES", 1000)  # 400 rows of one id are cut
    rows = labelled_rows(spark, 1000).withColumn("doc_id", F.when(F.col("doc_id") < 400, 5).otherwise(F.col("doc_id")))
    blocks = toxicity._blocks(rows.selectExpr("text", "cast(doc_id AS string) AS id", "toxic AS y", "lang"))
    sizes = {r["block"]: (r["rows"], r["toxic"]) for r in blocks.collect()}
    assert len(sizes) > 7 and sum(n for n, _ in sizes.values()) == 1000 and sum(t for _, t in sizes.values()) == 200
    places, clean, toxic = {}, 0, 0
    for at, k in enumerate(sorted(sizes)):
        places[k] = toxicity.Place(at, clean, toxic)
        clean, toxic = clean + sizes[k][0] - sizes[k][1], toxic + sizes[k][1]
    texts, held = [], {0: 0, 1: 0}
    for batch in blocks.toArrow().to_batches():
        for _, codes, y, lang, out in toxicity._opened(batch, places):
            assert len(codes) == len(y) == len(lang) == len(out)
            texts += [c.tobytes() for c in codes]
            for v in held:
                held[v] += int(out[y == v].sum())
    assert held == {0: 200, 1: 50} and len(texts) == 1000
    assert len(set(texts)) == rows.select("text").distinct().count()


def test_several_blocks_make_one_model(spark, monkeypatch):
    """Means over more blocks than are averaged at once; the same in every run."""
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 150)
    monkeypatch.setattr(toxicity, "FAN", 3)
    rows = labelled_rows(spark, 2000)
    one, two = toxicity.fit(rows, *COLS), toxicity.fit(rows.repartition(5), *COLS)
    for a, b in ((one.embed, two.embed), (one.out, two.out), (one.cuts, two.cuts), *zip(one.filters, two.filters)):
        assert np.array_equal(a, b) and np.isfinite(a).all()
    assert one.offset == two.offset
    got = toxicity.predict(one, rows, "doc_id", "text", [F.col("toxic")])
    assert got.where("predicted <> toxic").count() <= 10


def test_a_mean_counts_only_what_changed():
    import pyarrow as pa
    row = lambda x: np.full((1, 2 * toxicity.DIM), x, np.float32)
    tables = [toxicity._message([k], np.array(ids), np.concatenate([row(x) for x in values]), np.full(len(ids), w))
              for k, ids, values, w in ((1, [4], [5.0], 3.0), (0, [2, 4], [7.0, 1.0], 1.0))]
    told = pa.Table.from_batches(tables).append_column("up", pa.array([0] * 2))
    got = toxicity._mean(told).to_pylist()[0]
    values = np.frombuffer(got["values"], np.float32).reshape(-1, 2 * toxicity.DIM)
    assert np.frombuffer(got["ids"], np.int64).tolist() == [2, 4] and values[:, 0].tolist() == [7.0, 4.0]
    assert np.frombuffer(got["weights"], np.float64).tolist() == [1.0, 4.0]


def test_long_texts_are_looked_at_alone(monkeypatch):
    texts = [np.ones((n, 3), np.uint16) for n in (5, 6, 40, 1, 0, 3)]
    monkeypatch.setattr(toxicity, "RUN_WORDS", 12)
    runs = list(toxicity._runs(texts))
    assert [np.diff(first).tolist() for _, first in runs] == [[5, 6], [40], [1, 0, 3]]
    assert all(len(codes) == first[-1] for codes, first in runs)
