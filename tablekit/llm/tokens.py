"""Token ids of many texts, each distinct piece of text encoded once.

A byte-level BPE splits a text into words before it merges bytes, and no token
crosses certain places: before a run of ASCII white space that follows another
character, and between an ASCII letter (or a letter of U+00C0-U+00FF) and an
ASCII sign. Texts are cut there, equal pieces are found by Arrow's dictionary
encoding, and only pieces that are not remembered go to the tokenizer, several
to a call. Ids are those of whole-text encoding; tests compare them.

Texts with white space outside ASCII, where a run of white space could reach
across a cut, and texts with a special token's own string are encoded whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from .base import Texts, buffers
from .words import hash_spans

#: Distinct pieces that one worker remembers; all are dropped when there are more.
MEMORY = 1 << 19
#: Bytes of pieces that one call of the tokenizer encodes.
CALL_BYTES = 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SIGN = np.zeros(256, bool)
_SIGN[0x21:0x7F] = True
_SIGN &= ~_LETTER
_SIGN[0x30:0x3A] = False
_SIGN[0x27] = False  # an apostrophe may begin a contraction
#: White space outside ASCII, in UTF-8.
_WIDE = (rb"\xc2\x85|\xc2\xa0|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_ENCODERS: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder of a tokenizer file, with what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class _Growing:
    """An array that grows at its end."""

    def __init__(self, dtype: type):
        self.data, self.used = np.empty(1 << 12, dtype), 0

    def append(self, values: np.ndarray) -> None:
        to = self.used + len(values)
        if to > len(self.data):
            self.data = np.concatenate([self.data, np.empty(max(len(self.data), to), self.data.dtype)])
        self.data[self.used:to] = values
        self.used = to


class Encoder:
    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of each id: a token's characters stand for bytes.
        self.bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes[i] = len(token)
        special = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile(b"|".join([_WIDE, *special]))
        self._reset()

    def _reset(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending hashes, their pieces
        self.flat, self.first, self.size = _Growing(np.uint32), _Growing(np.int64), _Growing(np.int64)
        self.text, self.byte, self.length = _Growing(np.uint8), _Growing(np.int64), _Growing(np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, names: pa.Array, keys: np.ndarray) -> np.ndarray:
        """Remember pieces; their numbers."""
        pieces, (data, offs) = names.to_pylist(), buffers(names)
        size = np.diff(offs)
        # Pieces that begin with white space and do not end with it can share a call.
        shares = np.fromiter((p[0] in " \n\r\t\v\f" and not p[-1].isspace() for p in pieces), bool, len(pieces))
        joint, sole = np.flatnonzero(shares), np.flatnonzero(~shares)
        first, many = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        call = np.cumsum(size[joint]) // CALL_BYTES
        edge = np.flatnonzero(np.diff(call, prepend=-1, append=-1)) if len(joint) else np.zeros(1, np.int64)
        groups = [joint[x:y] for x, y in zip(edge[:-1], edge[1:])]
        for own, ids in zip(groups, self._encode(["".join([pieces[i] for i in own]) for own in groups])):
            ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(size[own]), side="left") + 1
            ends = np.concatenate([[0], np.minimum(ends, len(ids))])
            first[own], many[own] = self.flat.used + ends[:-1], np.diff(ends)
            self.flat.append(ids[:ends[-1]])
        for i, ids in zip(sole, self._encode([pieces[i] for i in sole])):
            first[i], many[i] = self.flat.used, len(ids)
            self.flat.append(ids)
        number = self.first.used + np.arange(len(pieces))
        self.first.append(first)
        self.size.append(many)
        self.byte.append(self.text.used + offs[:-1] - offs[0])
        self.length.append(size)
        self.text.append(data[offs[0]:offs[-1]])
        keys, at = np.unique(keys, return_index=True)
        place = np.searchsorted(self.keys, keys)
        fresh = np.append(self.keys, np.uint64(0))[place] != keys  # a taken hash stays with its piece
        fresh |= place == len(self.keys)
        self.slot = np.insert(self.slot, place[fresh], number[at[fresh]])
        self.keys = np.insert(self.keys, place[fresh], keys[fresh])
        return number

    def _numbers(self, names: pa.Array) -> np.ndarray:
        """The numbers of distinct pieces; those that are not remembered are learnt.

        Pieces are found by a 64-bit hash, and their bytes are compared."""
        data, offs = buffers(names)
        keys = hash_spans(data, offs[:-1], offs[1:])
        if self.first.used > MEMORY:
            self._reset()
        number = np.full(len(names), -1)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            size = np.diff(offs)
            like = np.flatnonzero((self.keys[at] == keys) & (self.length.data[self.slot[at]] == size))
            own, size = self.slot[at[like]], size[like]
            lead = np.cumsum(size) - size
            step = np.arange(size.sum())
            differ = (data[np.repeat(offs[like] - lead, size) + step]
                      != self.text.data[np.repeat(self.byte.data[own] - lead, size) + step])
            same = np.ones(len(like), bool)
            same[np.searchsorted(lead, np.flatnonzero(differ), side="right") - 1] = False
            number[like[same]] = own[same]
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = self._learn(names.take(pa.array(new)), keys[new])
        return number

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, first)``: text i has the ids ``ids[first[i]:first[i + 1]]``."""
        return self.encode_pieces(texts)[:2]

    def encode_pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, and for each piece its first byte and its first id."""
        data, offs = np.ascontiguousarray(texts.data), texts.offs
        n = len(offs) - 1
        if not len(data):
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64), none, none
        space = _SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        letter = _LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        cut[1:-1] |= _SIGN[data[1:]] & letter[:-1]
        for m in self.whole.finditer(data.tobytes()):  # the whole text around is one piece
            i = int(np.searchsorted(offs, m.start(), side="right")) - 1
            cut[offs[i]:offs[i + 1]] = False
        cut[offs[:-1]] = True
        cut[-1] = False
        begin = np.flatnonzero(cut).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(begin), pa.py_buffer(np.append(begin, np.int32(len(data)))), pa.py_buffer(data)).dictionary_encode()
        number = self._numbers(pieces.dictionary)[pieces.indices.to_numpy()]
        lo, size = self.first.data[number], self.size.data[number]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat.data[np.repeat(lo - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(begin, offs)], begin, total[:-1]
