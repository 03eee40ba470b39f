"""Language identification by multilingual mixture inference.

Training counts byte trigrams inside words for each language and keeps, per
language, a conditional log-probability of a byte after the two before it (a
word is framed by spaces). A word's likelihood under a language is the product
over its bytes.

A text is a mixture: each word is drawn from one of the languages with unknown
proportions, which expectation-maximisation estimates. The language set is
selected by penalised likelihood: sets of the 1, 2, ... most likely languages
are fitted and each further language must raise the log-likelihood by more
than ``PENALTY * log(words)``. The prediction is the set's largest share.

Fitting takes at most about ``TRAIN_ROWS`` labelled rows; prediction reads
every whole text.

Defined results: a null text or one without a letter is ``und`` with score 0;
so is every text if there was no labelled row. ``score`` is the share of the
predicted language in the selected mixture, or for a set of one language its
posterior against the others, spread over the words. Repeated rows are
predicted alike; a null id is kept. Other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Texts, arrow_map, fixed_sample, slices
from .words import BY_LETTER, lower, spans

UNKNOWN = "und"
#: Labelled rows that the model is fitted on, at most (about).
TRAIN_ROWS = 8000
#: Hash buckets of the trigram table; additive smoothing of its counts.
BUCKETS, ALPHA, SYMBOLS = 1 << 16, 0.5, 64
ROUNDS, PENALTY = 8, 2.0
#: Bytes of text inferred at once: small enough for the processor's cache.
INFER_BYTES = 256 << 10
#: A text whose largest share is lower has no dominant language.
MIN_SHARE = 0.3

_SPACE = np.uint32(0x20)


def _trigrams(texts: Texts):
    """``(codes, begin, first)``: codes of word i are ``codes[begin[i]:begin[i+1]]``;
    text t has the words ``first[t]..first[t+1]``."""
    low = lower(texts.data, latin=True)
    starts, ends = spans(low, texts.offs, BY_LETTER)
    first = np.searchsorted(starts, texts.offs)
    size = ends - starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    # Each word is laid out with one space after it.
    sym = np.full(begin[-1], _SPACE, np.uint32)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    mask = np.zeros(len(low) + 1, np.int8)
    mask[starts] += 1
    mask[ends] -= 1
    sym[inside] = low[np.cumsum(mask[:-1], dtype=np.int8).astype(bool)]
    one, two = np.full_like(sym, _SPACE), np.full_like(sym, _SPACE)
    one[1:], two[2:] = sym[:-1], sym[:-2]
    two[begin[:-1]] = _SPACE
    return (two << np.uint32(16)) | (one << np.uint32(8)) | sym, begin, first


def _bucket(codes: np.ndarray) -> np.ndarray:
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - 16)


def has_letter(raw: bytes) -> bool:
    if any(c in raw for c in b"ETAOINetaoin"):
        return True
    return any(ch.isalpha() for ch in raw.decode("utf-8", "replace"))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (languages, BUCKETS) log-probabilities; 0 where no language has the trigram


def fit(rows: DataFrame, text_col: str, lang_col: str, id_col: str, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on rows whose language is set; ``id_col`` only fixes the sample."""
    rows = rows.where(F.col(lang_col).isNotNull())
    rows = fixed_sample(rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                                    F.col(id_col).alias("id")), "id", train_rows).select("lang", "text")

    def make():
        def batch(part: pa.RecordBatch):
            langs = np.array(part.column(0).to_pylist(), object)
            for lang in dict.fromkeys(langs):
                texts = part.column(1).filter(pa.array(langs == lang))
                for run in slices(texts):
                    codes, counts = np.unique(_trigrams(run)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)),
                         pa.array(counts.astype(np.int64))], ["lang", "code", "n"])
        return batch
    counted = (arrow_map(rows, make, "lang string, code long, n long")
               .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "code"]))
    langs = sorted(counted["lang"].unique())
    table = np.zeros((len(langs), BUCKETS), np.float32)
    codes, total = counted["code"].to_numpy(np.uint32), counted["n"].to_numpy(np.float64)
    which = np.searchsorted(langs, counted["lang"].to_numpy(object)) if langs else np.zeros(0, int)
    all_codes, at = np.unique(codes, return_inverse=True)
    three = np.zeros((len(langs), len(all_codes)))
    three[which, at] = total
    context, back = np.unique(all_codes >> np.uint32(8), return_inverse=True)
    two = np.zeros((len(langs), len(context)))
    for k in range(len(langs)):
        two[k] = np.bincount(back, three[k], minlength=len(context))
    logp = np.log((three + ALPHA) / (two[:, back] + ALPHA * SYMBOLS))
    order = np.argsort(three.sum(0), kind="stable")  # of trigrams in one bucket the most frequent counts
    table[:, _bucket(all_codes[order])] = logp[:, order]
    return Model(langs, table)


def _sum(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of non-empty runs ``edges[i]:edges[i+1]`` along the last axis."""
    return np.add.reduceat(values, edges[:-1], axis=-1)


def infer(model: Model, texts: Texts):
    """``(best, score, size)`` per text: language index (-1: none), share, set size."""
    n, k = len(texts), len(model.langs)
    best, score, size = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    codes, begin, first = _trigrams(texts)
    some = np.flatnonzero(np.diff(first) > 0)
    if not len(some) or not k:
        return best, score, size
    bucket = _bucket(codes)
    word = np.stack([_sum(row[bucket], begin) for row in model.table])
    edges = np.append(first[some], first[-1])
    count = np.diff(edges).astype(np.float32)
    doc = np.repeat(np.arange(len(some)), np.diff(edges))
    alone = _sum(word.astype(np.float64), edges)                  # log-likelihood of one language
    top = word.max(0)
    lik = np.exp(word - top)
    base = _sum(top.astype(np.float64), edges)
    share = np.full((k, len(some)), 1.0 / k, np.float32)

    def climb(share, rounds):
        for _ in range(rounds):
            joint = share[:, doc] * lik
            joint /= np.maximum(joint.sum(0), np.float32(1e-30))
            share = _sum(joint, edges) / count
        return share
    share = climb(share, ROUNDS)
    order = np.argsort(-share, axis=0, kind="stable")
    chosen = alone.argmax(0)
    value = alone.max(0)
    spread = np.exp((alone - value) / np.sqrt(count))
    result = spread.max(0) / spread.sum(0)
    sets = np.ones(len(some), np.int64)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(k)[:, None], axis=0)
    for m in range(2, k + 1):
        part = np.where(rank < m, np.maximum(share, np.float32(1e-6)), np.float32(0))
        part = climb(part / part.sum(0), 3)
        mixed = base + _sum(np.log(np.maximum((part[:, doc] * lik).sum(0), np.float32(1e-30))).astype(np.float64), edges) \
            - PENALTY * (m - 1) * np.log(count + 1)
        better = mixed > value
        value = np.where(better, mixed, value)
        sets[better] = m
        chosen = np.where(better, part.argmax(0), chosen)
        result = np.where(better, part.max(0), result)
    best[some], score[some], size[some] = chosen, np.clip(result, 0.0, 1.0), sets
    return best, score, size


def predict(model: Model, docs: DataFrame, id_col: str, text_col: str, keep: list[Column] | None = None,
            with_text: bool = False) -> DataFrame:
    """``(id_col, ..., lang_pred, score, n_langs, rejected)``; ``keep``: further
    columns; ``with_text`` keeps the text as ``__text``."""
    docs = docs.select(F.col(text_col).alias("__text"), F.col(id_col), *(keep or []))
    skip = 0 if with_text else 1
    fields = docs.schema.fields[skip:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(0), INFER_BYTES):
                best, score, size = infer(model, part)
                raw = part.data.tobytes()
                letters = np.array([has_letter(raw[a:b]) for a, b in zip(part.offs[:-1], part.offs[1:])], bool)
                known = letters & (best >= 0)
                named = [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, known)]
                score = np.where(known, score, 0.0)
                drop = score < MIN_SHARE if model.langs else ~letters
                yield pa.RecordBatch.from_arrays(
                    [*(c[part.rows] for c in rows.columns[skip:]), pa.array(named, pa.string()), pa.array(score),
                     pa.array(np.where(known, size, 0)), pa.array(drop)],
                    [f.name for f in fields] + ["lang_pred", "score", "n_langs", "rejected"])
        return batch
    return arrow_map(docs, make, f"{schema}, lang_pred string, score double, n_langs long, rejected boolean")
