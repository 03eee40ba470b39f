"""Toxicity: a convolutional text classifier in numpy over hashed word embeddings.

A word is the sum of three hashed embeddings: the whole word and its first
four and five bytes (inflected forms share them). Filters of one, two and three
words are applied at every position of the whole text; each filter's largest
value over the text enters a logistic output. Embeddings start from the
smoothed log-odds of their words, then everything is trained together; the
gradient of a maximum reaches only the position that attains it.

Thresholds are calibrated by language on rows kept out of training: a text's
language is guessed from its own words (naive Bayes on the training rows), and
each language gets the cut that separates its calibration rows best, shrunk to
the common one where they are few. The score is shifted so that 0.5 is the cut.

Fitting reads the whole text of every labelled row. Rows are dealt by their ids
into blocks of hashed words on disk. In an epoch each block is learned from the
common parameters by a task, a few texts a step; then each parameter (and its
squared gradients) becomes the mean over the blocks that changed it, weighted by
their rows. Up to ``BLOCK_ROWS`` rows are one block, learned step by step. The
driver sees word counts, means and counts of calibration scores, never texts.

Defined results: null and empty texts have no words and get the score of the
padding alone. Without labelled rows of both classes every score is 0. Repeated
rows are scored alike; null ids are kept. Other columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Texts, arrow_map, bounded_batches, materialize, slices
from .words import BY_LETTER, hash_spans, lower, spans

#: Labelled rows and bytes of their texts in a block, about; one that outgrows twice that is cut.
BLOCK_ROWS, BLOCK_BYTES = 8_000, 24 << 20
BUCKETS, DIM = 1 << 16, 16
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, SEED = 4, 32, 0.05, 11
#: One in this many labelled rows calibrates thresholds instead of training.
CALIBRATION = 4
#: Positive calibration rows of a language that count as much as the common threshold.
SHRINK = 5.0
#: Scores of calibration rows are counted in bins of this part of a logit.
CUT_BINS = 1024
#: Bytes of text scored at once; words looked at together in training (a longer text is alone).
SCORE_BYTES, RUN_WORDS = 256 << 10, 1 << 18
#: Blocks whose parameters are averaged at once; rows of parameters that go together.
FAN, SLICE_ROWS = 64, 1024
PREFIXES = (4, 5)
_PAD = max(WIDTHS)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, first)``: a row of hashed ids per word (0 is padding); text i has
    the rows ``first[i]:first[i + 1]``."""
    low = lower(texts.data, latin=True)
    starts, ends = spans(low, texts.offs, BY_LETTER)
    codes = np.empty((len(starts), 1 + len(PREFIXES)), np.int32)
    for k, length in enumerate((None, *PREFIXES)):
        stop = ends if length is None else np.minimum(ends, starts + length)
        h = hash_spans(low, starts, stop) + np.uint64(k * 0x9E3779B9)
        codes[:, k] = ((h >> np.uint64(20)) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
    return codes, np.searchsorted(starts, texts.offs)


def _padded(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text followed by padding words."""
    n = len(first) - 1
    at = np.arange(len(codes)) + _PAD * np.repeat(np.arange(n), np.diff(first))
    out = np.zeros((len(codes) + _PAD * n, codes.shape[1]), np.int32)
    out[at] = codes
    return out, first + _PAD * np.arange(n + 1)


@dataclass
class Model:
    embed: np.ndarray                # (BUCKETS, DIM); row 0 is zero
    filters: list[np.ndarray]        # per width: (width, DIM, FILTERS)
    bias: np.ndarray                 # (len(WIDTHS) * FILTERS,)
    out: np.ndarray
    offset: float
    langs: list[str] = field(default_factory=list)
    words: np.ndarray | None = None  # (languages, BUCKETS) log-probabilities
    cuts: np.ndarray | None = None   # logit threshold per language, last: common


def _responses(m: Model, x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Filter responses at every position that may attain a maximum."""
    flat = x @ np.concatenate([f.transpose(1, 0, 2).reshape(DIM, -1) for f in m.filters], axis=1)
    y, at = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32), 0
    for k, w in enumerate(WIDTHS):
        part = y[:, k * FILTERS:(k + 1) * FILTERS]
        part[:] = flat[:, at:at + FILTERS]
        for j in range(1, w):
            part[:-j] += flat[j:, at + j * FILTERS:at + (j + 1) * FILTERS]
        at += w * FILTERS
    for j in range(1, _PAD):  # windows that start in the padding see the next text
        y[first[1:] - j] = -np.inf
    return y


def logits(m: Model, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    codes, first = _padded(codes, first)
    x = m.embed[codes[:, 0]]
    for k in range(1, codes.shape[1]):
        x += m.embed[codes[:, k]]
    top = np.maximum.reduceat(_responses(m, x, first), first[:-1], axis=0)
    return (np.maximum(top + m.bias, 0) @ m.out + m.offset).astype(np.float64)


def languages(m: Model, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of the likeliest language by the text's own words; -1 without words."""
    n = len(first) - 1
    best = np.full(n, -1)
    some = np.flatnonzero(np.diff(first))
    if len(some) and m.langs:
        edge = first[some]
        best[some] = np.stack([np.add.reduceat(w[codes[:, 0]], edge) for w in m.words]).argmax(0)
    return best


def score(m: Model, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    z = logits(m, codes, first) - m.cuts[languages(m, codes, first)]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _runs(texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(codes, first)`` of consecutive texts, about ``RUN_WORDS`` words at a time."""
    at = 0
    while at < len(texts):
        to, words = at, 0
        while to < len(texts) and (to == at or words + len(texts[to]) <= RUN_WORDS):
            words += len(texts[to])
            to += 1
        yield np.concatenate(texts[at:to]), np.concatenate([[0], np.cumsum([len(c) for c in texts[at:to]])])
        at = to


@dataclass
class Training:
    model: Model
    past: list[np.ndarray]        # squared gradients of embed, filters, bias, out
    rng: np.random.Generator      # of the first block
    heavy: float                  # weight of a toxic row


def _start(seen: np.ndarray, n0: int, n1: int) -> Training:
    """``seen``: texts of each class that hold a hashed word, of ``n0`` and ``n1``."""
    rng = np.random.default_rng(SEED)
    n0, n1 = np.float32(n0), np.float32(n1)
    odds = np.log((seen[1] + 0.1) / (n1 + 0.2)) - np.log((seen[0] + 0.1) / (n0 + 0.2))
    embed = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    embed[:, 0] += 0.1 * np.where(seen.sum(0) >= 2, odds, 0)
    embed[0] = 0
    filters = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0] = np.abs(f[0, 0]) + 0.5
    m = Model(embed, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32),
              np.full(len(WIDTHS) * FILTERS, 0.3, np.float32), -2.0)
    past = [np.full_like(p, 1e-3) for p in (embed, *filters, m.bias, m.out)]
    return Training(m, past, rng, min(10.0, float(n0) / max(1.0, float(n1))))


def _learn(t: Training, codes: list[np.ndarray], label: np.ndarray, order: np.ndarray, rate: float) -> np.ndarray:
    """One pass over the texts in this order, in place; which words' embeddings changed."""
    m, past, changed = t.model, t.past, np.zeros(BUCKETS, bool)
    weight = np.where(label == 1, t.heavy, 1.0)
    for b in range(0, len(order), BATCH):
        pick = order[b:b + BATCH]
        top, near = [], []
        for flat, first in _runs([codes[i] for i in pick]):
            flat, edge = _padded(flat, first)
            y = _responses(m, m.embed[flat].sum(1), edge)
            where = np.stack([s + y[s:e].argmax(0) for s, e in zip(edge[:-1], edge[1:])])
            top.append(np.take_along_axis(y, where.reshape(-1, y.shape[1]), axis=0))
            near.append([flat[where[:, k * FILTERS:(k + 1) * FILTERS] + j] for k, w in enumerate(WIDTHS) for j in range(w)])
        top = np.concatenate(top) + m.bias
        near = [np.concatenate(c) for c in zip(*near)]  # the words that each maximum saw
        act = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ m.out + m.offset, -40, 40)))
        delta = ((p - label[pick]) * weight[pick] / len(pick)).astype(np.float32)
        back = delta[:, None] * m.out * (top > 0)
        grads = {"out": act.T @ delta, "bias": back.sum(0)}
        rows, parts, seen = [], [], iter(near)
        for k, w in enumerate(WIDTHS):
            d = back[:, k * FILTERS:(k + 1) * FILTERS]
            g = np.zeros_like(m.filters[k])
            for j in range(w):
                ids = next(seen)
                g[j] = np.einsum("ifd,if->df", m.embed[ids].sum(2), d)
                rows.append(ids.reshape(-1, ids.shape[2]))
                parts.append((m.filters[k][j].T[None] * d[:, :, None]).reshape(-1, DIM))
            past[1 + k] += g * g
            m.filters[k] -= rate * g / np.sqrt(past[1 + k])
        ids = np.concatenate(rows).T.reshape(-1)
        uniq, inv = np.unique(ids, return_inverse=True)
        g = np.zeros((len(uniq), DIM), np.float32)
        np.add.at(g, inv, np.tile(np.concatenate(parts), (1 + len(PREFIXES), 1)))
        g[uniq == 0] = 0
        past[0][uniq] += g * g
        m.embed[uniq] -= rate * g / np.sqrt(past[0][uniq])
        changed[uniq] = True
        for name, i in (("bias", -2), ("out", -1)):
            past[i] += grads[name] ** 2
            setattr(m, name, getattr(m, name) - rate * grads[name] / np.sqrt(past[i]))
        m.offset -= rate * float(delta.sum())
    return changed


def _dense(t: Training) -> np.ndarray:
    """Parameters besides the embeddings, as rows like theirs."""
    m = t.model
    high = np.float32(m.offset)
    flat = np.concatenate([*(a.reshape(-1) for a in (*m.filters, m.bias, m.out, *t.past[1:])),
                           np.array([high, m.offset - float(high)], np.float32)])
    return np.pad(flat, (0, -len(flat) % (2 * DIM))).reshape(-1, 2 * DIM)


def _put(t: Training, ids: np.ndarray, values: np.ndarray) -> None:
    """Rows of parameters: an embedding and its squared gradients, or a row of ``_dense``."""
    words = ids < BUCKETS
    t.model.embed[ids[words]], t.past[0][ids[words]] = values[words, :DIM], values[words, DIM:]
    if not words.all():
        m, flat, at = t.model, values[~words].reshape(-1), 0
        for a in (*m.filters, m.bias, m.out, *t.past[1:]):
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size
        m.offset = float(flat[at]) + float(flat[at + 1])


def _binary(a: np.ndarray) -> pa.Array:
    """One binary value, not copied."""
    a = np.ascontiguousarray(a)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, a.nbytes], np.int32)), pa.py_buffer(a)])


def _blocks(rows: DataFrame) -> DataFrame:
    """Labelled rows ``(text, id, y, lang)`` as blocks of hashed words, the same ones in every run."""
    bounded_batches(rows)
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // BLOCK_ROWS), -(-size // BLOCK_BYTES))
    dealt = rows.repartition(parts, "id").sortWithinPartitions(F.col("id").asc_nulls_last(), "text", "y", "lang")

    def block(number: int, held: list) -> pa.RecordBatch:
        codes, words, y, lang = zip(*held)
        y = np.concatenate(y)
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(y)]), pa.array([int(y.sum())]),
             _binary(np.concatenate(codes)), _binary(np.concatenate(words)), _binary(y),
             pa.array([[v for part in lang for v in part]], pa.list_(pa.string()))],
            ["block", "rows", "toxic", "codes", "words", "y", "lang"])

    def run(batches):
        held, rows, size, made = [], 0, 0, 0
        for batch in batches:
            for part in slices(batch.column(0), SCORE_BYTES):
                codes, first = features(part)
                held.append((codes.astype(np.uint16), np.diff(first), batch.column(1)[part.rows].to_numpy().astype(np.uint8),
                             batch.column(2)[part.rows].to_pylist()))
                rows, size, number = rows + len(part), size + len(part.data), (batch.column(3)[0].as_py() << 32) + made
                if rows >= 2 * BLOCK_ROWS or size >= 2 * BLOCK_BYTES:
                    yield block(number, held)
                    held, rows, size, made = [], 0, 0, made + 1
        if held:
            yield block(number, held)
    dealt = dealt.select("text", "y", "lang", F.spark_partition_id().alias("part"))
    out = dealt.mapInArrow(run, "block long, rows long, toxic long, codes binary, words binary, y binary, lang array<string>")
    return materialize(out, "toxic_blocks")


@dataclass
class Place:
    at: int        # among the blocks
    clean: int     # rows of each class in the blocks before
    toxic: int


def _opened(batch: pa.RecordBatch, places: dict[int, Place]):
    """``(place, codes of each text, labels, languages, held out)`` of each block."""
    for i, number in enumerate(batch["block"].to_pylist()):
        codes = np.frombuffer(batch["codes"][i].as_buffer(), np.uint16).reshape(-1, 1 + len(PREFIXES))
        edge = np.cumsum(np.frombuffer(batch["words"][i].as_buffer(), np.int64))
        y = np.frombuffer(batch["y"][i].as_buffer(), np.uint8).astype(np.float32)
        place, held = places[number], np.zeros(len(y), bool)
        for v, before in ((0, place.clean), (1, place.toxic)):  # of each class one in CALIBRATION, if it has that many
            held[np.flatnonzero(y == v)[(CALIBRATION - 1 - before) % CALIBRATION::CALIBRATION]] = True
        yield place, np.split(codes, edge[:-1]), y, batch["lang"][i].as_py(), held


def _counts(blocks: DataFrame, places: dict[int, Place]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Texts of each class to learn from that hold a hashed word; whole words of each language."""
    def make():
        def batch(rows: pa.RecordBatch):
            for _, codes, y, lang, held in _opened(rows, places):
                found = {}
                for v in (0, 1):
                    texts = [np.unique(codes[i]) for i in np.flatnonzero((y == v) & ~held)]
                    found[None, v] = np.concatenate([np.zeros(0, np.uint16), *texts])
                for name in {v for v in lang if v is not None}:
                    found[name, None] = np.concatenate([c[:, 0] for c, v in zip(codes, lang) if v == name])
                for (name, v), ids in found.items():
                    n = np.bincount(ids, minlength=BUCKETS)
                    some = np.flatnonzero(n) if v is not None else np.flatnonzero(n + (np.arange(BUCKETS) == 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some), pa.string()), pa.array([v] * len(some), pa.int32()),
                         pa.array(some.astype(np.int32)), pa.array(n[some])], ["lang", "y", "bucket", "n"])
        return batch
    got = arrow_map(blocks, make, "lang string, y int, bucket int, n long")
    got = got.groupBy("lang", "y", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang, bucket, n = got["lang"].to_pylist(), got["bucket"].to_numpy(), got["n"].to_numpy()
    y = got["y"].fill_null(-1).to_numpy()
    seen = np.zeros((2, BUCKETS))
    for v in (0, 1):
        seen[v, bucket[y == v]] = n[y == v]
    words = {v: np.zeros(BUCKETS) for v in sorted({v for v in lang if v is not None})}
    for k in np.flatnonzero(y == -1):
        words[lang[k]][bucket[k]] = n[k]
    return seen, words


def _epoch(t: Training, blocks: DataFrame, places: dict[int, Place], epoch: int) -> None:
    """Every block learns from the same parameters; means of what they changed."""
    def make():
        def batch(rows: pa.RecordBatch):
            for place, codes, y, _, held in _opened(rows, places):
                learn = np.flatnonzero(~held)
                if not len(learn):
                    continue
                own = copy.deepcopy(t)
                rng = own.rng if place.at == 0 else np.random.default_rng([SEED, place.at])
                for _ in range(epoch):
                    rng.permutation(len(learn))
                changed = _learn(own, [codes[i] for i in learn], y[learn], rng.permutation(len(learn)), RATE / (1 + epoch))
                ids, rest = np.flatnonzero(changed), _dense(own)
                values = np.concatenate([np.concatenate([own.model.embed[ids], own.past[0][ids]], axis=1), rest])
                ids = np.concatenate([ids, BUCKETS + np.arange(len(rest))])
                yield _message([place.at], ids, values, np.full(len(ids), float(len(learn))))
        return batch
    told = arrow_map(blocks, make, MESSAGE)
    left = len(places)
    while True:
        told = told.withColumn("up", F.floor(F.col("block") / FAN)).groupBy("up", "slice").applyInArrow(_mean, MESSAGE)
        left = -(-left // FAN)
        if left <= 1:
            break
    for row in told.select("ids", "values").toArrow().to_pylist():
        _put(t, np.frombuffer(row["ids"], np.int64), np.frombuffer(row["values"], np.float32).reshape(-1, 2 * DIM))


#: Rows of parameters (``slice``: of ids) with the training rows behind each.
MESSAGE = "block long, slice long, ids binary, values binary, weights binary"


def _message(block: list[int], ids: np.ndarray, values: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    numbers, first = np.unique(ids // SLICE_ROWS, return_index=True)
    edge = [*first, len(ids)]
    cut = lambda a, kind: pa.array([a[i:j].astype(kind).tobytes() for i, j in zip(edge, edge[1:])], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(block * len(numbers), pa.int64()), pa.array(numbers, pa.int64()), cut(ids, np.int64),
         cut(values, np.float32), cut(weights, np.float64)], ["block", "slice", "ids", "values", "weights"])


def _mean(table: pa.Table) -> pa.Table:
    """The weighted means of a slice over some blocks, summed in the order of the blocks."""
    table = table.sort_by("block")
    ids, weights = ([np.frombuffer(v, kind) for v in table[c].to_pylist()] for c, kind in (("ids", np.int64), ("weights", np.float64)))
    every = np.unique(np.concatenate(ids))
    total, behind = np.zeros((len(every), 2 * DIM)), np.zeros(len(every))
    for at, w, v in zip(ids, weights, table["values"].to_pylist()):
        at = np.searchsorted(every, at)  # ids are distinct within a message
        total[at] += np.frombuffer(v, np.float32).reshape(-1, 2 * DIM) * w[:, None]
        behind[at] += w
    return pa.Table.from_batches([_message([table["up"][0].as_py()], every, total / behind[:, None], behind)])


def _cut(n: np.ndarray, hits: np.ndarray, low: np.ndarray, high: np.ndarray) -> float:
    """The logit that separates the classes with the best F1, halfway between scores.
    Bins from the highest: their rows, the toxic ones among them, least and largest logit."""
    f1 = 2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())
    k = int(f1.argmax())
    return float((low[k] + high[k + 1]) / 2) if k + 1 < len(n) else float(low[k] - 1)


def _calibrate(m: Model, blocks: DataFrame, places: dict[int, Place], every: bool) -> None:
    """Thresholds by guessed language on the held-out rows (on all rows if ``every``)."""
    def make():
        def batch(rows: pa.RecordBatch):
            for _, codes, y, _, held in _opened(rows, places):
                test = np.arange(len(y)) if every else np.flatnonzero(held)
                for b in range(0, len(test), BATCH):
                    runs = list(_runs([codes[i] for i in test[b:b + BATCH]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([languages(m, *r) for r in runs]).astype(np.int64)),
                         pa.array(np.concatenate([logits(m, *r) for r in runs])),
                         pa.array(y[test[b:b + BATCH]].astype(np.int64))], ["guess", "z", "y"])
        return batch
    z = arrow_map(blocks, make, "guess long, z double, y long")
    bins = z.groupBy("guess", F.floor(F.col("z") * CUT_BINS).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"), F.min("z").alias("low"), F.max("z").alias("high"))
    got = bins.toPandas()
    whole = got.groupby("bin").agg({"n": "sum", "hits": "sum", "low": "min", "high": "max"}).reset_index()

    def cut(of) -> float:
        of = of.sort_values("bin", ascending=False)
        return _cut(*(of[c].to_numpy() for c in ("n", "hits", "low", "high")))
    common = cut(whole)
    m.cuts = np.full(len(m.langs) + 1, common)
    for k in range(len(m.langs)):
        own = got[got["guess"] == k]
        n = np.float32(own["hits"].sum())
        if n and n < own["n"].sum():
            m.cuts[k] = (n * cut(own) + SHRINK * common) / (n + SHRINK)


def fit(rows: DataFrame, text_col: str, label_col: str, lang_col: str, id_col: str) -> Model | None:
    """Fit on all labelled rows (0/1); the language column only supervises the guess
    of languages. None without rows of both classes."""
    rows = rows.where(F.col(label_col).isin(0, 1))
    blocks = _blocks(rows.select(F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id"),
                                 F.col(label_col).cast("int").alias("y"), F.col(lang_col).cast("string").alias("lang")))
    places, n0, n1 = {}, 0, 0
    for at, (number, n, toxic) in enumerate(sorted(map(tuple, blocks.select("block", "rows", "toxic").collect()))):
        places[number] = Place(at, n0, n1)
        n0, n1 = n0 + n - toxic, n1 + toxic
    if not n0 or not n1:
        return None
    seen, words = _counts(blocks, places)
    t = _start(seen, n0 - n0 // CALIBRATION, n1 - n1 // CALIBRATION)
    for epoch in range(EPOCHS):
        _epoch(t, blocks, places, epoch)
    m = t.model
    m.langs = list(words)
    if m.langs:
        count = np.stack(list(words.values())) + 0.1
        m.words = np.log(count / count.sum(1, keepdims=True)).astype(np.float32)
    _calibrate(m, blocks, places, every=min(n0, n1) < CALIBRATION)
    return m


def predict(model: Model | None, docs: DataFrame, id_col: str, text_col: str,
            keep: list[Column] | None = None, with_text: bool = False) -> DataFrame:
    """``(id_col, ..., score, predicted)``; ``keep``: further columns; ``with_text``
    keeps the text as ``__text``."""
    docs = docs.select(F.col(text_col).alias("__text"), F.col(id_col), *(keep or []))
    skip = 0 if with_text else 1
    fields = docs.schema.fields[skip:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(0), SCORE_BYTES):
                s = np.zeros(len(part)) if model is None else score(model, *features(part))
                yield pa.RecordBatch.from_arrays(
                    [*(c[part.rows] for c in rows.columns[skip:]), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    [f.name for f in fields] + ["score", "predicted"])
        return batch
    return arrow_map(docs, make, f"{schema}, score double, predicted int")
