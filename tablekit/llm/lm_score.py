"""Cross-entropy difference of a target and a background n-gram model.

Both are word bigram models over one vocabulary, all words of the two corpora:

    P(w | v) = (c(v, w) + kinds(v) * p(w)) / (c(v) + kinds(v))

Witten-Bell interpolation with a unigram ``p`` that is smoothed additively; the
context of a text's first word is a start mark. A text's score is its mean loss
under the target model minus that under the background model: the lower, the
more it is like the target.

Nothing is cut by rank or count, and no word or bigram is a row. A chunk, some MB
of texts, is one row: its distinct words and its texts as places among them.

* A chunk's distinct bigrams are cut into shards by their hash and sent as sorted,
  packed arrays. A shard's task adds them up over all chunks and answers each
  chunk with the counts of its bigrams in both corpora.
* Of the chunks that hold a bigram, one is told to count it as a kind of its
  context, so the kinds of a word are sums over chunks, too.
* A chunk's words are sent in the same way, with how often they end and begin
  bigrams and with their kinds, and answered with the sums.
* With all that a chunk's task adds up the losses of its texts.

A common word or bigram is at most one entry per chunk, and the hash deals them
evenly, so no shard is hot; the number of shards follows the number of words.
Words are compared by a 64-bit hash, bigrams by a 64-bit hash of two.

Defined results: null and empty texts and texts without words have 0 tokens,
losses 0 and score 0. A word that neither corpus has gets the unigram of count 0,
and as a context gives the unigram. An empty target corpus gives a smoothed
uniform model. Null ids are kept; repeated rows count and are scored as they
come. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .base import arrow_map, materialize, slices
from .words import BY_LETTER, mix, words

#: Smoothing count of a word.
ALPHA = 0.1
#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Bigrams of all chunks that a shard holds, about.
SHARD_PAIRS = 1 << 21

#: What a text is for, as bits.
TARGET, BACKGROUND, WANTED = 1, 2, 4
CHUNK = "chunk long, words binary, ids array<long>, sizes array<int>, uses array<int>, places binary"


def squeeze(*columns: np.ndarray) -> bytes:
    """Equally long columns as compressed bytes, low bytes of all numbers first."""
    rows = np.stack([c.astype(np.uint64) for c in columns])
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(rows.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes())


def expand(raw: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint64)[:, :, 0]


@dataclass
class Chunk:
    """Texts as places among the chunk's words; word 0 is the start mark."""

    words: np.ndarray
    place: np.ndarray   # of every word of every text
    before: np.ndarray  # of the word before it
    sizes: np.ndarray   # words per text
    uses: np.ndarray    # bits per text

    @classmethod
    def of(cls, words_, place, sizes, uses) -> "Chunk":
        before = np.zeros_like(place)
        before[1:] = place[:-1]
        first = np.cumsum(sizes) - sizes
        before[first[sizes > 0]] = 0
        return cls(words_, place, before, sizes, uses)

    @classmethod
    def read(cls, sizes, uses, words_: bytes, places: bytes) -> "Chunk":
        return cls.of(np.frombuffer(words_, "<u8"), expand(places, 1)[0].astype(np.int64), sizes.astype(np.int64), uses)

    def used(self, bit: int) -> np.ndarray:
        """Whether each place belongs to a text of that use."""
        return np.repeat(self.uses & bit > 0, self.sizes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(codes, at, number)``: sorted distinct bigrams, a place of each, and each place's bigram."""
        code = mix(self.words[self.before] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.place])
        return np.unique(code, return_index=True, return_inverse=True)


def write_chunks(rows: DataFrame, path: str) -> None:
    """``rows``: ``(text, id, use)``."""
    def make():
        task, seq = TaskContext.get().partitionId(), 0

        def batch(table: pa.RecordBatch):
            nonlocal seq
            for part in slices(table.column(0), CHUNK_BYTES):
                h, first = words(part, BY_LETTER, True)
                own, place, n = np.unique(h, return_inverse=True, return_counts=True)
                often = np.argsort(-n, kind="stable")  # small places for common words compress best
                rank = np.empty(len(own), np.int64)
                rank[often] = np.arange(1, len(own) + 1)
                seq += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | seq - 1]),
                     pa.array([np.concatenate([np.zeros(1, np.uint64), own[often]]).astype("<u8").tobytes()], pa.binary()),
                     pa.array([table.column(1)[part.rows].to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.diff(first).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([table.column(2)[part.rows].to_numpy().astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([squeeze(rank[place])], pa.binary())],
                    [x.split()[0] for x in CHUNK.split(", ")])
        return batch
    arrow_map(rows, make, CHUNK).write.option("compression", "zstd").parquet(path)


#: Columns that a chunk is read from.
TEXTS = ["sizes", "uses", "words", "places"]


def _chunks_of(table: pa.RecordBatch):
    """The chunks of a batch whose first columns are ``TEXTS``."""
    for i in range(table.num_rows):
        lists = [table.column(k)[i].values.to_numpy(zero_copy_only=False) for k in range(2)]
        yield i, Chunk.read(*lists, *(table.column(k)[i].as_py() for k in (2, 3)))


def _requests(chunk: int, shift: int, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """``(shard, chunk, packed)``: sorted keys with their columns, cut by the keys' upper bits."""
    shard = (keys >> np.uint64(64 - shift)).astype(np.int64) if shift else np.zeros(len(keys), np.int64)
    edge = np.flatnonzero(np.diff(shard, prepend=-1, append=-1)) if len(keys) else np.zeros(1, np.int64)
    packed = [squeeze(np.diff(keys[a:b], prepend=np.uint64(0)), *(x[a:b] for x in columns))
              for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(shard[edge[:-1]]), pa.array([chunk] * len(packed), pa.int64()),
                                       pa.array(packed, pa.binary())], ["shard", "chunk", "packed"])


def _by_chunk(asked: DataFrame, columns: int, kinds: bool) -> DataFrame:
    """Sum the requests' columns per key and answer each chunk, ``(chunk, packed array<binary>, found)``.

    With ``kinds`` a last column tells, as bits, for which corpora the chunk is the one
    that counts the key; ``found`` are the keys that either of the first two columns holds.
    """
    def answer(table: pa.Table) -> pa.Table:
        asks = [expand(x, columns + 1) for x in table["packed"].to_pylist()]
        edge = np.cumsum([0] + [a.shape[1] for a in asks]).tolist()
        _, number = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asks]), return_inverse=True)
        each = [np.concatenate([a[1 + k] for a in asks]) for k in range(columns)]
        totals = [np.bincount(number, n.astype(np.float64)) for n in each]
        out = [t[number].astype(np.uint64) for t in totals]
        if kinds:
            owner = np.zeros(len(number), np.uint64)
            for bit, n in enumerate(each[:2]):
                holds = np.flatnonzero(n)
                owner[holds[np.unique(number[holds], return_index=True)[1]]] |= np.uint64(1 << bit)
            out.append(owner)
        packed = [squeeze(*(x[a:b] for x in out)) for a, b in zip(edge[:-1], edge[1:])]
        found = [int(((totals[0] > 0) | (totals[1] > 0)).sum())] + [0] * (len(packed) - 1)
        return pa.table({"chunk": table["chunk"], "shard": table["shard"], "packed": pa.array(packed, pa.binary()),
                         "found": pa.array(found, pa.int64())})
    told = asked.groupBy("shard").applyInArrow(answer, "chunk long, shard long, packed binary, found long")
    return (told.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "packed"))).alias("x"),
                                      F.sum("found").alias("found"))
            .select("chunk", F.col("x.packed").alias("packed"), "found"))


def _told(column: pa.ListScalar, columns: int) -> np.ndarray:
    """The answers of a chunk's shards in order of its keys, a row per column."""
    parts = [expand(x, columns) for x in column.as_py()] if column.is_valid else []
    return np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((columns, 0), np.int64)


def _bigram_answers(chunks: DataFrame, shift: int) -> DataFrame:
    """Counts of each chunk's distinct bigrams in the target and the background, and the owner's bits."""
    def make():
        def batch(table: pa.RecordBatch):
            for i, c in _chunks_of(table):
                codes, _, number = c.pairs()
                yield _requests(table.column(4)[i].as_py(), shift, codes, *(
                    np.bincount(number[c.used(bit)], minlength=len(codes)) for bit in (TARGET, BACKGROUND)))
        return batch
    return _by_chunk(arrow_map(chunks.select(*TEXTS, "chunk"), make, "shard long, chunk long, packed binary"), 2, True)


def _word_answers(chunks: DataFrame, bigrams: DataFrame, shift: int) -> DataFrame:
    """Of each chunk's words in ascending order: how often they end and begin a bigram of
    the target and the background, and the kinds of words after them."""
    def make():
        def batch(table: pa.RecordBatch):
            for i, c in _chunks_of(table):
                size = len(c.words)
                _, at, _ = c.pairs()
                owner = _told(table.column(4)[i], 3)[2]
                counts = [np.bincount(x[c.used(bit)], minlength=size) for x in (c.place, c.before)
                          for bit in (TARGET, BACKGROUND)]
                counts += [np.bincount(c.before[at[owner & bit > 0]], minlength=size) for bit in (1, 2)]
                order = np.argsort(c.words)
                yield _requests(table.column(5)[i].as_py(), shift, c.words[order], *(x[order] for x in counts))
        return batch
    asked = arrow_map(chunks.select(*TEXTS, "chunk").join(bigrams, "chunk", "left").select(*TEXTS, "packed", "chunk"),
                      make, "shard long, chunk long, packed binary")
    return _by_chunk(asked, 6, False)


def score_texts(rows: DataFrame, id_col: str, text_col: str, target: Column, background: Column,
                wanted: Column) -> DataFrame:
    """``(id_col, n_tokens, target_loss, background_loss, score)`` per wanted row.

    The conditions say which rows each model learns from and which are scored; all
    that is read once. A null condition is false.
    """
    spark = rows.sparkSession
    use = sum((F.when(F.coalesce(c, F.lit(False)), bit).otherwise(0)
               for c, bit in ((target, TARGET), (background, BACKGROUND), (wanted, WANTED))), F.lit(0))
    path = scratch_path(spark, "llm", "lm_chunks")
    write_chunks(rows.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"),
                             use.cast("int").alias("use")), path)
    chunks = spark.read.schema(CHUNK).parquet(path)

    def words_of(bits: int) -> Column:
        counted = F.zip_with("sizes", "uses", lambda n, u: F.when(u.bitwiseAND(bits) > 0, n).otherwise(0))
        return F.sum(F.aggregate(counted, F.lit(0).cast("long"), lambda a, x: a + x))
    total, *totals = (x or 0 for x in chunks.agg(*map(words_of, (TARGET | BACKGROUND | WANTED, TARGET, BACKGROUND))).first())
    shift = max(0, int(total // SHARD_PAIRS)).bit_length()
    bigrams = materialize(_bigram_answers(chunks, shift), "lm_bigrams")
    known = materialize(_word_answers(chunks, bigrams, shift), "lm_words")
    # The start mark ends no bigram, so it is no word of the vocabulary.
    cells = ALPHA * ((known.agg(F.sum("found")).first()[0] or 0) + 1)

    def make():
        def batch(table: pa.RecordBatch):
            for i, c in _chunks_of(table):
                number = c.pairs()[2]
                told = _told(table.column(4)[i], 3)
                words_ = np.empty((6, len(c.words)), np.int64)
                words_[:, np.argsort(c.words)] = _told(table.column(5)[i], 6)
                text = np.repeat(np.arange(len(c.sizes)), c.sizes)
                losses = []
                for k in (0, 1):
                    ends, seen, kinds = words_[k][c.place], words_[2 + k][c.before], words_[4 + k][c.before]
                    one = (ends + ALPHA) / (totals[k] + cells)
                    p = np.where(seen > 0, (told[k][number] + kinds * one) / np.maximum(seen + kinds, 1), one)
                    losses.append(np.bincount(text, -np.log(p), len(c.sizes)) / np.maximum(c.sizes, 1))
                keep = c.uses & WANTED > 0
                yield pa.RecordBatch.from_arrays(
                    [table.column(6)[i].values.filter(pa.array(keep)), pa.array(c.sizes[keep].astype(np.int64)),
                     *(pa.array(x[keep]) for x in (*losses, losses[0] - losses[1]))],
                    ["id", "n_tokens", "target_loss", "background_loss", "score"])
        return batch
    told = bigrams.select("chunk", F.col("packed").alias("b")).join(
        known.select("chunk", F.col("packed").alias("w")), "chunk", "full")
    out = arrow_map(chunks.join(told, "chunk", "left").select(*TEXTS, "b", "w", "ids"), make,
                    "id long, n_tokens long, target_loss double, background_loss double, score double")
    return out.withColumnRenamed("id", id_col)


@dataclass
class Models:
    """Two corpora, in the first column of each frame."""

    background: DataFrame
    target: DataFrame


def fit(background: DataFrame, target: DataFrame) -> Models:
    return Models(background, target)


def score(models: Models, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``score_texts`` for documents that need not be in a corpus, and corpora that need not share texts."""
    none = F.lit(None).cast("bigint").alias("id")
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"), F.lit(WANTED).alias("use"))
    for corpus, use in ((models.target, TARGET), (models.background, BACKGROUND)):
        rows = rows.unionByName(corpus.select(F.col(corpus.columns[0]).cast("string").alias("text"), none, F.lit(use).alias("use")))
    out = score_texts(rows, "id", "text", *(F.col("use") == bit for bit in (TARGET, BACKGROUND, WANTED)))
    return out.withColumnRenamed("id", id_col)
