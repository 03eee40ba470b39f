"""Benchmark decontamination by latent semantic retrieval.

1. Passages (``WINDOW`` words, every ``STRIDE`` words) of all documents are
   TF-IDF vectors over hashed terms; document frequencies cover all documents.
2. A randomised SVD of TF-IDF passages gives ``RANK`` latent dimensions. It is
   fitted on the benchmark items and the passages of all documents, items
   weighted to the energy of the documents, so that their directions are kept:
   each power step multiplies by the matrix and its transpose inside the tasks
   and sums the partial products of the tasks in shards of terms. The hashed
   terms of all texts are kept once, two bytes a word, for 1. and 2.
3. Every passage of every document is projected; items whose latent cosine
   with it reaches ``COSINE`` are candidates.
4. A candidate is contaminated if the longest common subsequence of item and
   document (words, in a window around the passage) covers ``COVER`` of the
   item, and if either the item's answer, its last ``ANSWER`` words, is covered
   by ``COVER_ANSWER`` in the part that matched (paraphrases: scattered matches),
   or one run of it with gaps of at most ``GAP`` words covers ``COVER`` of the
   item by itself (partial copies, wherever the item is cut).

The benchmark is the query set; ``ITEM_BLOCK`` items share one latent space, and
larger benchmarks are taken in blocks, each with a pass over the documents.

Defined results: null or empty documents and items match nothing. Several
windows that find the same item give one row with the best cover. Repeated
rows of a document give one row. Rows with a null id are left out. Other
columns are ignored. Words are compared by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Texts, arrow_map, bounded_batches, buffers, materialize, slices
from .words import BY_LETTER, words

TERMS = 1 << 13
STRIDE = 24
WINDOW = 2 * STRIDE
ITEM_BLOCK, RANK, OVERSAMPLE, POWER, SEED = 208, 224, 16, 1, 7
COSINE = 0.15
COVER, ANSWER, COVER_ANSWER = 0.6, 8, 0.5
#: Rows that are summed at once, few enough for the processor's cache, and one after another.
PART, SUMMED = 512, 32
#: Bytes of texts or terms of one numpy pass, and a kept term.
SLICE, TERM = 1 << 20, "<u2"
#: Words left out between two matches of a run, in the item or in the text.
GAP = 2


def term(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(24)).astype(np.int64) & (TERMS - 1)


def term_table(docs: DataFrame) -> DataFrame:
    """``(terms, chars)``: each text's hashed terms as 16-bit integers, in order, and its
    length; written once, as three passes read them. First column: text."""
    def make():
        def batch(rows: pa.RecordBatch):
            chars = rows.column(1)
            for part in slices(rows.column(0), SLICE):
                h, first = words(part, BY_LETTER, True)
                held = [None, pa.py_buffer((2 * first).astype(np.int32)), pa.py_buffer(term(h).astype(TERM))]
                yield pa.RecordBatch.from_arrays(
                    [pa.Array.from_buffers(pa.binary(), len(part), held),
                     chars.slice(part.rows.start, len(part))], ["terms", "chars"])
        return batch
    docs = docs.select("text", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("chars"))
    return materialize(arrow_map(docs, make, "terms binary, chars long"), "terms")


def _kept_terms(column: pa.Array):
    """``(rows, terms, first)`` of runs of texts of a ``terms`` column."""
    for part in slices(column, SLICE):
        yield part.rows, part.data.view(TERM), part.offs // 2


def document_frequencies(terms: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed term, and their number. First column: terms."""
    def make():
        def batch(rows: pa.RecordBatch):
            total = np.zeros(TERMS, np.int64)
            for _, t, first in _kept_terms(rows.column(0)):
                held = np.repeat(np.arange(len(first) - 1), np.diff(first)) * TERMS + t
                held.sort()
                total += np.bincount(held[np.diff(held, prepend=-1) > 0] & (TERMS - 1), minlength=TERMS)
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(hit, -1)), pa.array(np.append(total[hit], rows.num_rows))], ["t", "n"])
        return batch
    got = arrow_map(terms, make, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(TERMS)
    own = got[got["t"] >= 0]
    df[own["t"].to_numpy()] = own["n"].to_numpy()
    return df, int(got.loc[got["t"] < 0, "n"].sum())


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, stop)`` of all windows of a run of texts, as word positions."""
    size = np.diff(first)
    many = np.where(size > 0, np.maximum(size - WINDOW, 0) // STRIDE + 1 + (np.maximum(size - WINDOW, 0) % STRIDE > 0), 0)
    text = np.repeat(np.arange(len(size)), many)
    rank = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    start = first[:-1][text] + rank * STRIDE
    return text, start, np.minimum(start + WINDOW, first[1:][text])


def _block_sums(table: np.ndarray, t: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``table[t]`` over blocks of ``STRIDE`` words of each text, and each
    text's first block. The last row of ``table`` and of the sums is zero."""
    size = np.diff(first)
    many = -(-size // STRIDE)
    lead = np.concatenate([[0], np.cumsum(many)])
    text = np.repeat(np.arange(len(size)), many)
    start = first[:-1][text] + (np.arange(lead[-1]) - lead[text]) * STRIDE
    padded = np.append(t, np.full(STRIDE, len(table) - 1))
    out = np.zeros((lead[-1] + 1, table.shape[1]), table.dtype)
    held = np.empty((PART, table.shape[1]), table.dtype)
    for k in range(0, lead[-1], PART):
        at = start[k:k + PART] + np.arange(STRIDE)[:, None]
        own = np.where(at < first[1:][text[k:k + PART]], padded[at], len(table) - 1)
        sums, more = out[k:k + at.shape[1]], held[:at.shape[1]]
        np.take(table, own[0], axis=0, out=sums, mode="clip")  # with "clip" numpy takes no copy
        for j in range(1, STRIDE):
            sums += np.take(table, own[j], axis=0, out=more, mode="clip")
    return out, lead


def _projected(table: np.ndarray, t: np.ndarray, first: np.ndarray):
    """Sums of ``table[t]`` over all windows, their texts, and the blocks that each has;
    a window of one block has the row after all blocks as its second."""
    text, start, stop = _windows(first)
    sums, lead = _block_sums(table, t, first)
    block = lead[text] + (start - first[:-1][text]) // STRIDE
    after = np.where(stop - start > STRIDE, block + 1, lead[-1])
    latent = np.take(sums, block, axis=0)
    latent += np.take(sums, after, axis=0)
    return latent, text, block, after, lead


def _tfidf_rows(h: np.ndarray, idf: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Sparse windows: term and normalised weight per position, with window numbers."""
    size = stop - start
    row = np.repeat(np.arange(len(start)), size)
    at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    t = term(h[at])
    w = idf[t]
    norm = np.sqrt(np.bincount(row, w * w, minlength=len(start)))
    return row, t, w / np.maximum(norm[row], 1e-12)


def orthonormal(z: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of a tall matrix, from its small Gram matrix."""
    for _ in range(2):  # the second pass removes the first one's rounding
        value, vector = np.linalg.eigh((z.T @ z).astype(np.float64))
        some = value > max(value[-1], 1e-30) * 1e-9
        z = z @ (vector[:, some] / np.sqrt(value[some])).astype(np.float32)
    return z


def _spread_sums(out: np.ndarray, t: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """``out[t[i]] += values[at[i]]`` for all i.

    Equal ``t`` are cut in runs of at most ``SUMMED``. Runs of a part are summed side
    by side, the longest first, so that those that go on are its beginning; their sums
    are summed in the same way until each ``t`` has one."""
    while len(t):
        order = np.argsort(t, kind="stable")
        t, at = t[order], at[order]
        head = np.flatnonzero(np.diff(t, prepend=-1))
        size = np.diff(np.append(head, len(t)))
        many = -(-size // SUMMED)
        start = np.repeat(head, many) + SUMMED * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        size = np.minimum(np.repeat(head + size, many) - start, SUMMED)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        sums = np.empty((len(start), values.shape[1]), values.dtype)
        held = np.empty((PART, values.shape[1]), values.dtype)
        for k in range(0, len(start), PART):
            own, n = start[k:k + PART], size[k:k + PART]
            np.take(values, at[own], axis=0, out=sums[k:k + PART], mode="clip")
            for j in range(1, n[0]):
                on = int(np.searchsorted(-n, -j))
                sums[k:k + on] += np.take(values, at[own[:on] + j], axis=0, out=held[:on], mode="clip")
        if len(start) == len(head):
            out[t[start]] += sums
            return
        t, at, values = t[start], np.arange(len(start)), sums


def randomised_svd(rows: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Right singular vectors ``(TERMS, RANK)`` of the weighted TF-IDF passages of
    ``rows`` (terms, weight).

    The matrix stays with the tasks. A step sends an orthonormal basis Q to
    them and returns ``A' (A Q)``, one partial sum a task, added in shards of
    terms; only matrices of ``TERMS x (RANK + OVERSAMPLE)`` reach the driver.
    The last step needs ``Q' A' A Q`` alone, the products of the columns of ``A Q``.
    """
    bounded_batches(rows)

    def table(terms: np.ndarray, values: np.ndarray, kind: type) -> pa.RecordBatch:
        # Each row by its largest value, so that half precision is enough for a subspace.
        scale = np.maximum(np.abs(values).max(1, initial=0), 1e-30).astype(np.float32)
        small = (values / scale[:, None]).astype(kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(terms), pa.array(scale), pa.array([row.tobytes() for row in small], pa.binary())], ["t", "s", "v"])

    def summed(q: np.ndarray | None, last: bool) -> np.ndarray:
        rank = RANK + OVERSAMPLE if q is None else q.shape[1]
        kind = np.float32 if last else np.float16
        sent = None if q is None else q.astype(np.float16)  # a task's copy is small

        def rows_of(part: pa.Table) -> np.ndarray:
            values = np.frombuffer(b"".join(part["v"].to_pylist()), kind).reshape(-1, rank)
            return values.astype(np.float32) * part["s"].to_numpy()[:, None]

        def add(part: pa.Table) -> pa.Table:
            terms, at = np.unique(part["t"].to_numpy(), return_inverse=True)
            out = np.zeros((len(terms), rank), np.float32)
            _spread_sums(out, at, np.arange(len(at)), rows_of(part))
            return pa.Table.from_batches([table(terms, out, kind)])

        def run(parts):
            # The first basis is random; tasks make it from the seed.
            q = (np.random.default_rng(SEED).normal(size=(TERMS, rank)) if sent is None else sent).astype(np.float32)
            weighted = np.zeros((TERMS + 1, rank + 1), np.float32)  # the last row is padding
            weighted[:-1, :-1] = q * idf[:, None]
            weighted[:-1, -1] = idf ** 2
            out = np.zeros((rank, rank)) if last else np.zeros((TERMS, rank), np.float32)
            for part in parts:
                weight = part.column(1).to_numpy()
                for own, t, first in _kept_terms(part.column(0)):
                    if not len(t):
                        continue
                    latent, text, block, after, lead = _projected(weighted, t, first)
                    # Both sides of A'A have the passage's norm and its text's weight.
                    factor = (weight[own][text] ** 2 / np.maximum(latent[:, -1], 1e-12)).astype(np.float32)[:, None]
                    latent = latent[:, :-1]
                    if last:
                        out += latent.T @ (latent * factor)
                        continue
                    latent = latent * factor
                    back = np.zeros((lead[-1] + 1, rank), np.float32)
                    back[block] = latent
                    back[after] += latent  # the row after all blocks is of no use
                    size = np.diff(first)
                    own = np.repeat(np.arange(len(size)), size)
                    _spread_sums(out, t, lead[own] + (np.arange(len(t)) - first[:-1][own]) // STRIDE, back)
            if not last:
                out *= idf[:, None].astype(np.float32)
            hit = np.flatnonzero(out.any(1))
            yield table(hit, out[hit], kind)
        parts = rows.select("terms", "weight").mapInArrow(run, "t long, s float, v binary")
        got = parts.groupBy(F.pmod("t", F.lit(16))).applyInArrow(add, "t long, s float, v binary").toArrow()
        z = np.zeros((rank if last else TERMS, rank), np.float32)
        z[got["t"].to_numpy()] = rows_of(got)
        return z

    q = None
    for _ in range(POWER):
        q = orthonormal(summed(q, False))
    small = summed(q, True).astype(np.float64)                       # Q' A' A Q
    value, vector = np.linalg.eigh((small + small.T) / 2)
    return q @ vector[:, np.argsort(-value)[:RANK]].astype(np.float32)


def lcs_cover(item: np.ndarray, text: np.ndarray) -> tuple[float, float, float]:
    """Shares of the item, of its answer and of the longest run of matches with
    gaps of at most ``GAP`` words, in a longest common subsequence."""
    if not len(item) or not len(text):
        return 0.0, 0.0, 0.0
    table = np.zeros((len(item) + 1, len(text) + 1), np.int32)
    for i in range(len(item)):
        gain = table[i, :-1] + (text == item[i])
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(gain, table[i, 1:]))
    hit, i, j = np.zeros(len(item), bool), len(item), len(text)
    run, most, last = 0, 0, (i, j)
    while i and j:
        if item[i - 1] == text[j - 1] and table[i, j] == table[i - 1, j - 1] + 1:
            hit[i - 1] = True
            run = run + 1 if max(last[0] - i, last[1] - j) <= GAP else 1
            i, j = i - 1, j - 1
            most, last = max(most, run), (i, j)
        elif table[i - 1, j] >= table[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return float(hit.mean()), float(hit[-ANSWER:].mean()), most / len(item)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id_col, item_col, cosine, cover, answer_cover)`` of contaminated documents."""
    docs = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("id"))
    docs = docs.where("id is not null")
    items = (benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).alias("text"))
             .where("item is not null and text is not null").dropDuplicates(["item"]).orderBy("item").toArrow())
    out = "id long, item long, cosine double, cover double, answer double"
    column = pa.chunked_array(items["text"].chunks, pa.string()).combine_chunks()
    data, offs = buffers(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
    item_h, item_first = words(Texts(data[offs[0]:offs[-1]], offs - offs[0], slice(0, len(offs) - 1)), BY_LETTER, True)
    keep = np.flatnonzero(np.diff(item_first) > 0)
    names = {"id": id_col, "item": item_col, "answer": "answer_cover"}
    found = docs.sparkSession.createDataFrame([], out)
    if len(keep):
        terms = term_table(docs)
        df, total = document_frequencies(terms.select("terms"))
        idf = np.log((1 + total) / (1 + df)) + 0.05
        # Passages of all documents, about one every STRIDE words of six bytes.
        windows = terms.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0] / (6 * STRIDE)
        idents = items["item"].to_numpy()
        for k in range(0, len(keep), ITEM_BLOCK):
            block = keep[k:k + ITEM_BLOCK]
            found = found.unionByName(_retrieve(
                docs, terms, windows, idf, idents[block],
                [item_h[a:b] for a, b in zip(item_first[block], item_first[block + 1])], out))
    return (found.groupBy("id", "item")
            .agg(F.max("cosine").alias("cosine"), F.max("cover").alias("cover"), F.max("answer").alias("answer"))
            .withColumnsRenamed(names))


def _retrieve(docs: DataFrame, terms: DataFrame, windows: float, idf: np.ndarray, ident: np.ndarray,
              item_words: list[np.ndarray], out: str) -> DataFrame:
    """Contaminated documents of one block of items."""
    spark = docs.sparkSession
    weight = float(np.sqrt(max(1.0, windows / len(ident))))
    # A few partial sums a core: few matrices are moved, whatever the number of files.
    held = pa.array([term(h).astype(TERM).tobytes() for h in item_words], pa.binary())
    own = spark.createDataFrame(pa.table({"terms": held, "weight": [weight] * len(ident)}))
    rows = (terms.select("terms", F.lit(1.0).alias("weight")).coalesce(3 * spark.sparkContext.defaultParallelism)
            .unionByName(own.coalesce(1)))
    basis = randomised_svd(rows, idf)
    sent = (basis * 32).astype(np.float16)  # half precision on the way to the tasks
    basis = sent.astype(np.float32) / 32

    size = np.array([len(x) for x in item_words])
    stop = np.cumsum(size)
    row, t, w = _tfidf_rows(np.concatenate(item_words), idf, stop - size, stop)
    queries = np.add.reduceat(basis[t] * w[:, None].astype(np.float32),
                              np.flatnonzero(np.diff(row, prepend=-1)), axis=0)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    longest = int(size.max())
    # Places of the items' words among all of them; padding and other words come last.
    known = np.unique(np.concatenate(item_words))
    own_place = np.full((len(size), longest), len(known))
    for y, item in enumerate(item_words):
        own_place[y, :len(item)] = np.searchsorted(known, item)

    def make():
        weighted = np.zeros((TERMS + 1, sent.shape[1] + 1), np.float32)  # the last row is padding
        weighted[:-1, :-1] = sent.astype(np.float32) / 32 * idf[:, None]
        weighted[:-1, -1] = idf ** 2
        present = np.zeros(len(known) + 2, bool)
        maybe = np.zeros(1 << 16, bool)  # by a hash's first bits: most words are of no item
        maybe[known >> np.uint64(48)] = True

        def batch(rows: pa.RecordBatch):
            ids = rows.column(1).to_numpy()
            for part in slices(rows.column(0), SLICE):
                h, first = words(part, BY_LETTER, True)
                text, a, b = _windows(first)
                if not len(a):
                    continue
                latent = _projected(weighted, term(h), first)[0]
                best: dict[tuple[int, int], tuple] = {}
                # The last coordinate is the sum of squared weights.
                cosine = latent[:, :-1] @ queries.T
                cosine /= np.sqrt(np.maximum(latent[:, -1:], 1e-12))
                likely = cosine >= COSINE
                place = np.full(len(h), len(known) + 1)
                own = np.flatnonzero(maybe[h >> np.uint64(48)])
                near = np.minimum(np.searchsorted(known, h[own]), len(known) - 1)
                place[own] = np.where(known[near] == h[own], near, len(known) + 1)
                xs, own_ys = np.nonzero(likely)
                edge = np.flatnonzero(np.diff(xs, prepend=-1, append=-1)) if len(xs) else np.zeros(1, np.int64)
                x = xs[edge[:-1]]
                # The item may begin before or end after the window.
                los, his = np.maximum(first[text[x]], a[x] - longest), np.minimum(first[text[x] + 1], b[x] + longest)
                for x, lo, hi, k, to in zip(*(v.tolist() for v in (x, los, his, edge[:-1], edge[1:]))):
                    ys = own_ys[k:to]
                    present[place[lo:hi]] = True
                    present[-2:] = False
                    ys = ys[present[own_place[ys]].sum(1) >= COVER * size[ys]]
                    present[place[lo:hi]] = False
                    for y in ys:
                        cover, answer, run = lcs_cover(item_words[y], h[lo:hi])
                        if cover >= COVER and (answer >= COVER_ANSWER or run >= COVER):
                            key = (int(text[x]), int(ident[y]))
                            found = (cover, answer, float(cosine[x, y]))
                            best[key] = max(best.get(key, found), found)
                if best:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(ids[part.rows][d]) for d, _ in best]), pa.array([i for _, i in best]),
                         *(pa.array([v[k] for v in best.values()], pa.float64()) for k in (2, 0, 1))],
                        ["id", "item", "cosine", "cover", "answer"])
        return batch
    return arrow_map(docs, make, out)

