"""Order-preserving packing of token ids into sequences by dynamic programming.

Documents are taken in ascending id order as one stream of ids per range
partition, each document followed by an end id. A sequence is a window of the
stream of at most ``LENGTH`` ids. Cuts are allowed at document ends, at
sentence ends (at a penalty) and, only where neither lies within a window, at
the window's full length (at a higher one). With ``p`` the position of a cut,
the cheapest way to end a window at cut j is

    f(j) = penalty(j) + min over i, p(j) - p(i) <= LENGTH, of
           f(i) + LENGTH - (p(j) - p(i))

that is, the minimum of ``f(i) + p(i)`` over a sliding window, kept in a
monotone queue: linear in the number of cuts. Windows whose length is one of
``UNPADDED`` (powers of two) are not padded and are further transitions.

The stream is cut in runs of about ``RUN`` ids that share no state but the last
window, which is carried over; memory is that of a run and its longest document.

Defined results: a null text is empty, an empty document is its end id alone.
Every input row is a document, also repeated ones; rows with a null id come
first. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, slices
from .tokens import encoder

LENGTH = 2048
UNPADDED = (512, 1024)
#: Cost, in ids, of a cut at a sentence end, inside a sentence, and of a short window.
SENTENCE_CUT, HARD_CUT, SHORT = 4, 64, 8
RUN = 1 << 20

_STOP = np.zeros(256, bool)
_STOP[[0x21, 0x2E, 0x3F]] = True  # ! . ?
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def windows(cuts: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Chosen cuts, from 0 to the end; ``cuts`` ascend from 0, gaps are at most ``LENGTH``."""
    m = len(cuts)
    short: dict[int, list[int]] = {}  # few cuts have another one at such a distance
    for size in UNPADDED:
        i = np.searchsorted(cuts, cuts - size)
        hit = np.flatnonzero(cuts[np.minimum(i, m - 1)] == cuts - size)
        for j, at in zip(hit.tolist(), i[hit].tolist()):
            short.setdefault(j, []).append(at)
    pos, pen = cuts.tolist(), penalty.tolist()
    cost, back, key = [0] * m, [0] * m, [0] * m
    queue, head = [0], 0  # indices by ascending key
    for j in range(1, m):
        p = pos[j]
        while p - pos[queue[head]] > LENGTH:
            head += 1
        i = queue[head]
        best, at = key[i] + LENGTH - p, i
        for i in short.get(j, ()):
            if cost[i] + SHORT < best:
                best, at = cost[i] + SHORT, i
        cost[j], back[j] = best + pen[j], at
        key[j] = k = cost[j] + p
        while len(queue) > head and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    chosen = [m - 1]
    while chosen[-1]:
        chosen.append(back[chosen[-1]])
    return cuts[chosen[::-1]]


def with_hard_cuts(cuts: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adds cuts every ``LENGTH`` ids in gaps that are longer."""
    gap = np.flatnonzero(np.diff(cuts) > LENGTH)
    if not len(gap):
        return cuts, penalty
    more = np.concatenate([np.arange(cuts[g] + LENGTH, cuts[g + 1], LENGTH) for g in gap])
    order = np.argsort(np.concatenate([cuts, more]), kind="stable")
    return (np.concatenate([cuts, more])[order],
            np.concatenate([penalty, np.full(len(more), HARD_CUT)])[order])


class _Stream:
    """Ids and documents of one task that are not yet in a finished window."""

    def __init__(self, tokenizer: str, end_id: int, task: int):
        self.encoder, self.end_id = encoder(tokenizer), end_id
        self.sequence = task << 32
        self.ids, self.cuts, self.penalty = [], [], []
        self.size, self.documents = 0, []  # documents: (id, first position, ids)

    def add(self, idents: list, texts) -> None:
        ids, first, begin, piece = self.encoder.encode_pieces(texts)
        n = len(texts)
        self.ids.append(np.insert(ids, first[1:], self.end_id).astype(np.uint32))
        start, size = first[:-1] + np.arange(n) + self.size, np.diff(first) + 1
        self.documents += zip(idents, start.tolist(), size.tolist())
        # Sentence ends: before white space after . ! or ?, and before a new line.
        inside = np.flatnonzero(~np.isin(begin, texts.offs))
        b = begin[inside]
        ends = inside[(_STOP[texts.data[b - 1]] & _SPACE[texts.data[b]]) | (texts.data[b] == 10)]
        doc = np.searchsorted(texts.offs, begin[ends], side="right") - 1
        cuts = np.concatenate([piece[ends] + doc + self.size, start + size])
        kind = np.concatenate([np.full(len(ends), SENTENCE_CUT), np.zeros(n, np.int64)])
        order = np.argsort(cuts, kind="stable")
        self.cuts.append(cuts[order])
        self.penalty.append(kind[order])
        self.size += len(self.ids[-1])

    def pack(self, last: bool) -> pa.RecordBatch | None:
        if not self.size:
            return None
        ids = np.concatenate(self.ids)
        cuts, penalty = with_hard_cuts(np.concatenate([[0], *self.cuts]), np.concatenate([[0], *self.penalty]))
        chosen = windows(cuts, penalty)
        stop = len(ids) if last else int(chosen[-2])  # the last window is carried over
        chosen = chosen[chosen <= stop]
        start = np.array([d[1] for d in self.documents])
        edges = np.unique(np.concatenate([chosen, start[(start > 0) & (start < stop)]]))
        lo, hi = edges[:-1], edges[1:]
        doc = np.searchsorted(start, lo, side="right") - 1
        seq = np.searchsorted(chosen, lo, side="right") - 1
        out = None
        if len(lo):
            raw = ids[:stop].tobytes()
            out = pa.RecordBatch.from_arrays(
                [pa.array([self.documents[d][0] for d in doc], pa.int64()), pa.array(lo - start[doc]),
                 pa.array(hi - lo), pa.array([raw[4 * a:4 * b] for a, b in zip(lo.tolist(), hi.tolist())], pa.binary()),
                 pa.array([self.documents[d][2] for d in doc], pa.int64()), pa.array(self.sequence + seq),
                 pa.array(lo - chosen[seq])],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        self.sequence += len(chosen) - 1
        kept = cuts > stop
        self.ids, self.size = [ids[stop:]], len(ids) - stop
        self.cuts, self.penalty = [cuts[kept] - stop], [penalty[kept]]
        self.documents = [(d, s - stop, n) for d, s, n in self.documents if s + n > stop]
        return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` are little-endian unsigned 32-bit integers; ``tokenizer`` is the
    path of a tokenizer file, the same on every executor.
    """
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"))
    docs = docs.repartitionByRange("id").sortWithinPartitions("id")
    bounded_batches(docs)

    def run(batches):
        stream = _Stream(tokenizer, end_id, TaskContext.get().partitionId())
        for rows in batches:
            ids = rows.column(1).to_pylist()
            for part in slices(rows.column(0)):
                stream.add(ids[part.rows], part)
                if stream.size >= RUN:
                    out = stream.pack(last=False)
                    if out is not None:
                        yield out
        out = stream.pack(last=True)
        if out is not None:
            yield out
    return docs.mapInArrow(run, "id long, start long, length long, ids binary, doc_tokens long, "
                                "sequence_id long, offset long").withColumnRenamed("id", id_col)
