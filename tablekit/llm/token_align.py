"""Alignment of two tokenizers over the same bytes, and how often ids are linked.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model. A text
is given to both as ``space + text``. The cumulative byte ends of each id list
become a dictionary from end to index; the ends that both dictionaries hold,
sorted, slice the two lists into groups, and within a slice every A and B token
whose byte ranges overlap are linked.

Both tokenizers cut a text before a run of white space, so a text is handled as
a sequence of pieces and a worker aligns a piece once and remembers it. Where a
cut could change ids (see ``Aligner``), pieces stay joined.

Corpus-wide counts: a chunk is a few MB of texts. Its distinct id pairs, with
their numbers, are rows of a chunk table; Spark sums them over all chunks, joins
the sums back to the chunks, and a task adds them up per document. So what is
shuffled is a row per chunk and distinct pair, and a common pair is at most one
row per chunk.

Defined results: null and empty texts, and texts whose token bytes differ from
``space + text`` (such as one with U+2581), have no tokens: zeros and ''. Every
input row gives an output row, also repeated rows and null ids. Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .base import Texts, arrow_map, slices

#: Distinct pieces that one worker remembers; all are dropped when there are more.
MEMORY = 1 << 19
#: Bytes of new pieces that are encoded and aligned together.
CALL_BYTES = 1 << 16
#: Bytes of texts in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 4 << 20

_SPACE = b" \t\n\v\f\r"
#: White space outside ASCII, in UTF-8.
_WIDE = re.compile(rb"\xc2\x85|\xc2\xa0|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: sentencepiece's sign for a space.
_MARK = "▁"

_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


def aligner(a_path: str, b_path: str) -> "Aligner":
    """The worker's aligner of two tokenizer files, with what it remembers."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level BPE's entries stands for.

    Printable Latin-1 characters stand for themselves, the other bytes, in
    ascending order, for the characters from U+0100.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Groups and links of pieces of text.

    Pieces begin at a white-space byte after a character that is no white space,
    if neither tokenizer can join the two: A splits there by its pattern, and B
    has no entry with that byte after another character. White-space bytes that
    B does join (as ``;`` and CR) begin no piece; if A has another pattern, whole
    texts are pieces.
    """

    def __init__(self, a_path: str, b_path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        byte = byte_of_char()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        size = self.b.get_piece_size()
        plain = [i for i in range(size) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        self.b_bytes = [b""] * size
        for i in plain:
            self.b_bytes[i] = self.b.id_to_piece(i).replace(_MARK, " ").encode()
        for i in filter(self.b.is_byte, range(size)):
            self.b_bytes[i] = bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        joined = {y for i in plain for x, y in zip(self.b_bytes[i], self.b_bytes[i][1:]) if x not in _SPACE}
        splits = json.loads(self.a.to_str())["pre_tokenizer"]
        self.starts = np.zeros(256, bool)
        if splits and splits["type"] == "ByteLevel" and splits["use_regex"]:
            self.starts[[c for c in _SPACE if c not in joined]] = True
        self.blank = np.zeros(256, bool)
        self.blank[list(_SPACE)] = True
        self.anchor = self.b.encode("a", num_threads=1)
        self.a_text = [str(i) for i in range(len(self.a_bytes))]
        self.b_text = [str(i) for i in range(size)]
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[bytes | None] = []  # None: no tokens
        self.sizes = np.zeros((1024, 3), np.int32)  # A ids, B ids, groups
        self.start = np.zeros(1025, np.int64)
        self.links, self.used = np.zeros(4096, np.int64), 0

    def _add(self, pieces: list[str], texts: list[bytes | None], sizes: np.ndarray, n_links: np.ndarray,
             links: np.ndarray) -> None:
        at, n = len(self.text), len(pieces)
        while at + n > len(self.sizes):
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.start = np.concatenate([self.start, np.zeros(len(self.start) - 1, np.int64)])
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.known.update(zip(pieces, range(at, at + n)))
        self.text += texts
        self.sizes[at:at + n] = sizes
        self.links[self.used:self.used + len(links)] = links
        self.start[at + 1:at + n + 1] = self.used + np.cumsum(n_links)
        self.used += len(links)

    def _align(self, pieces: list[str]) -> None:
        """Align pieces whose joined text both tokenizers cut between them."""
        whole = "".join(pieces)
        a = self.a.encode(whole, add_special_tokens=False).ids
        if self.starts[ord(whole[0])]:  # cut off the word before, which took the model's own space
            b = self.b.encode("a" + whole, num_threads=1)[len(self.anchor):]
        else:
            b = self.b.encode(whole[1:], num_threads=1)
        raw = [p.encode() for p in pieces]
        joined = b"".join(raw)
        if b"".join([self.a_bytes[i] for i in a]) != joined or b"".join([self.b_bytes[i] for i in b]) != joined:
            if len(pieces) > 1:
                for p in pieces:
                    self._align([p])
            else:
                self._add(pieces, [None], np.zeros((1, 3), np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64))
            return
        a_ends = np.cumsum([len(self.a_bytes[i]) for i in a]).tolist()
        b_ends = np.cumsum([len(self.b_bytes[i]) for i in b]).tolist()
        a_at = dict(zip(a_ends, range(1, len(a) + 1)))  # byte end -> ids up to it
        b_at = dict(zip(b_ends, range(1, len(b) + 1)))
        common = sorted(a_at.keys() & b_at.keys())
        a_text, b_text = [self.a_text[i] for i in a], [self.b_text[i] for i in b]
        links: list[int] = []
        group_text, n_links = [], []
        i = j = 0
        for end in common:
            x, y = a_at[end], b_at[end]
            group_text.append(",".join(a_text[i:x]) + "|" + ",".join(b_text[j:y]))
            n_links.append(x - i + y - j - 1)
            if x - i == 1:
                links += [a[i] << 32 | k for k in b[j:y]]
            elif y - j == 1:
                links += [k << 32 | b[j] for k in a[i:x]]
            else:  # each pair of tokens whose byte ranges overlap
                p, q = i, j
                while p < x and q < y:
                    links.append(a[p] << 32 | b[q])
                    p, q = p + (a_ends[p] <= b_ends[q]), q + (b_ends[q] <= a_ends[p])
            i, j = x, y
        ends = np.cumsum([len(r) for r in raw])
        group = np.searchsorted(common, ends) + 1  # groups up to each piece's end
        first = np.concatenate([[0], group[:-1]]).tolist()
        upto = np.stack([np.array([d[e] for e in ends.tolist()]) for d in (a_at, b_at)] + [group], 1)
        self._add(pieces, [";".join(group_text[s:e]).encode() for s, e in zip(first, group.tolist())],
                  np.diff(upto, axis=0, prepend=0),
                  np.diff(np.concatenate([[0], np.cumsum(n_links)])[group], prepend=0), np.array(links, np.int64))

    def _learn(self, pieces: list[str]) -> None:
        group, held = [], 0
        for p in pieces:
            # Between two such pieces the joined text is cut as a text is.
            if len(p) < 256 and p[0] in " \t\n\v\f\r" and self.starts[ord(p[0])] and not p[-1].isspace():
                group.append(p)
                held += len(p)
                if held >= CALL_BYTES:
                    self._align(group)
                    group, held = [], 0
            else:
                self._align([p])
        if group:
            self._align(group)

    def pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(number, of, first)``: piece ``k`` of the batch is remembered as
        ``number[of[k]]`` (``number``: distinct pieces); text i has the pieces
        from ``first[i]`` to ``first[i + 1]``. Empty texts have none."""
        n = len(texts)
        length = np.diff(texts.offs)
        lead = texts.offs[:-1][length > 0]
        data = np.insert(texts.data, lead, 0x20)
        offs = texts.offs + np.concatenate([[0], np.cumsum(length > 0)])
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.starts[data[1:]] & ~self.blank[data[:-1]]
        for m in _WIDE.finditer(data.tobytes()):  # such a run may reach across
            cut[m.end()] = False
        cut[offs[:-1]] = True
        cut[-1] = False
        begin = np.flatnonzero(cut)
        column = pa.LargeStringArray.from_buffers(
            len(begin), pa.py_buffer(np.append(begin, len(data)).astype(np.int64)), pa.py_buffer(data))
        coded = column.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.known) > MEMORY:
            self._reset()
        known = self.known
        self._learn([p for p in names if p not in known])
        number = np.fromiter((known[p] for p in names), np.int64, len(names))
        return number, coded.indices.to_numpy(), np.searchsorted(begin, offs)

    def group_texts(self, number: np.ndarray, of: np.ndarray, first: np.ndarray) -> list[bytes | None]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``; None: no tokens."""
        names = [self.text[i] for i in number.tolist()]
        bad = np.fromiter((x is None for x in names), bool, len(names))[of]
        bad = np.concatenate([[0], np.cumsum(bad)])
        none = (first[1:] == first[:-1]) | (bad[first[1:]] > bad[first[:-1]])
        at, edge = of.tolist(), first.tolist()
        return [None if no else b";".join([names[k] for k in at[s:e]])
                for no, s, e in zip(none.tolist(), edge[:-1], edge[1:])]


def token_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id_col, groups)``: a document's groups as ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"))

    def make():
        tool = aligner(a_path, b_path)

        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(0), CHUNK_BYTES):
                found = [(x or b"").decode() for x in tool.group_texts(*tool.pieces(part))]
                yield pa.RecordBatch.from_arrays([rows.column(1)[part.rows], pa.array(found, pa.string())],
                                                 ["id", "groups"])
        return batch
    return arrow_map(docs, make, "id long, groups string").withColumnRenamed("id", id_col)


CHUNK = ("chunk long, a array<int>, b array<int>, n array<long>, ids array<long>, n_a array<long>, n_b array<long>, "
         "n_groups array<long>, n_links array<long>, digest array<string>, kinds array<long>, held binary")


def write_chunks(docs: DataFrame, path: str, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Align all documents; a row is a chunk: its distinct id pairs (``a``, ``b``) with
    their numbers ``n``, its documents, and which pairs each holds how often."""
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"))

    def make():
        tool, task, seq = aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=1)

        def batch(rows: pa.RecordBatch):
            nonlocal seq
            for part in slices(rows.column(0), CHUNK_BYTES):
                number, of, first = tool.pieces(part)
                texts = tool.group_texts(number, of, first)
                ok = np.fromiter((t is not None for t in texts), bool, len(texts))
                doc = np.repeat(np.arange(len(texts)), np.diff(first))
                doc, of = doc[ok[doc]], of[ok[doc]]
                sizes = np.zeros((len(texts), 3), np.int64)
                for k in range(3):
                    sizes[:, k] = np.bincount(doc, tool.sizes[number, k][of], len(texts))
                # Links of the distinct pieces as indices of the chunk's distinct pairs.
                lo, each = tool.start[number], tool.start[number + 1] - tool.start[number]
                at = np.cumsum(each) - each
                pairs, index = np.unique(
                    tool.links[np.repeat(lo - at, each) + np.arange(each.sum())], return_inverse=True)
                n = each[of]
                where = np.repeat(at[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                width = max(len(pairs), 1)
                key, times = np.unique(np.repeat(doc, n) * width + index[where], return_counts=True)
                held, pair = np.divmod(key, width)
                kinds = np.bincount(held, minlength=len(texts))
                total = np.bincount(pair, times, width)[:len(pairs)].astype(np.int64)
                used = total > 0  # a pair only of texts without tokens has none
                step = np.diff(pair, prepend=0)  # small within a document
                begun = (np.cumsum(kinds) - kinds)[kinds > 0]
                step[begun] = pair[begun]
                seq += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task << 32 | seq - 1]),
                     pa.array([(pairs >> 32)[used]], pa.list_(pa.int32())),
                     pa.array([(pairs & 0xFFFFFFFF)[used]], pa.list_(pa.int32())),
                     pa.array([total[used]], pa.list_(pa.int64())),
                     pa.array([rows.column(1)[part.rows].to_pylist()], pa.list_(pa.int64())),
                     *(pa.array([sizes[:, k]], pa.list_(pa.int64())) for k in range(3)),
                     pa.array([np.bincount(doc, n, len(texts)).astype(np.int64)], pa.list_(pa.int64())),
                     pa.array([["" if t is None else hashlib.sha256(t).hexdigest() for t in texts]],
                              pa.list_(pa.string())),
                     pa.array([kinds], pa.list_(pa.int64())),
                     pa.array([pack.compress(_renumber(step, pair, begun, used).astype(np.uint32).tobytes()
                                             + times.astype(np.uint32).tobytes())], pa.binary())],
                    [c.split()[0] for c in CHUNK.split(", ")])
        return batch
    arrow_map(docs, make, CHUNK).write.option("compression", "zstd").parquet(path)


def _renumber(step: np.ndarray, pair: np.ndarray, begun: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Steps between the pairs of a document, numbered among the used pairs."""
    if used.all():
        return step
    pair = (np.cumsum(used) - 1)[pair]
    step = np.diff(pair, prepend=0)
    step[begun] = pair[begun]
    return step


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A pair's count is the number of links of all documents that hold it. ``n_best``
    counts the links whose pair has the highest count of its B id, ``count_sum`` adds
    the counts of the links.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "llm", "aligned")
    write_chunks(docs, path, a_path, b_path, id_col, text_col)
    chunks = spark.read.schema(CHUNK).parquet(path)
    pairs = chunks.select("chunk", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pos", "x")) \
        .select("chunk", "pos", "x.a", "x.b", "x.n")
    folder = scratch_path(spark, "llm", "counts")
    pairs.groupBy("a", "b").agg(F.sum("n").alias("count")).write.parquet(folder)
    counts = spark.read.schema("a int, b int, count long").parquet(folder)
    best = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row per B id: the vocabulary bounds it
    counts = counts.join(F.broadcast(best), "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = (pairs.select("chunk", "pos", "a", "b").join(counts, ["a", "b"])
               .groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "count", "best"))).alias("x"))
               .select("chunk", F.col("x.count").alias("count"), F.col("x.best").alias("best")))
    own = ["ids", "n_a", "n_b", "n_groups", "n_links", "digest", "kinds", "held"]

    def make():
        unpack = zstandard.ZstdDecompressor()

        def batch(rows: pa.RecordBatch):
            for r in range(rows.num_rows):
                ids, n_a, n_b, n_groups, n_links, digest, kinds, held, count, best = (rows.column(k)[r] for k in range(10))
                kinds = kinds.values.to_numpy(zero_copy_only=False)
                step, times = np.frombuffer(unpack.decompress(held.as_py()), np.uint32).reshape(2, -1).astype(np.int64)
                edge = np.concatenate([[0], np.cumsum(kinds)])
                run = np.concatenate([[0], np.cumsum(step)])
                pair = run[1:] - np.repeat(run[edge[:-1]], kinds)
                score = count.values.to_numpy(zero_copy_only=False) if count.is_valid else np.zeros(0, np.int64)
                top = best.values.to_numpy(zero_copy_only=False) if best.is_valid else np.zeros(0, bool)
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * top[pair], times * score[pair])]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, n_a.values, n_b.values, n_groups.values, n_links.values,
                     *(pa.array(s[edge[1:]] - s[edge[:-1]]) for s in sums), digest.values],
                    ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
        return batch
    out = arrow_map(chunks.select("chunk", *own).join(answers, "chunk", "left").select(*own, "count", "best"), make,
                    "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                    "groups_sha256 string")
    return out.withColumnRenamed("id", id_col)
