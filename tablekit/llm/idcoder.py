"""Adaptive context-mixing range coder for token ids, many blocks in lockstep.

The file starts with a table of its ids and how often each occurs. A block is
coded on its own: its model starts from that table, and it carries a checksum.
Step t codes the t-th id of every block at once, so each numpy call works on one
id of up to ``LANES`` blocks.

Predictions of an id, from the ids before it in its block:

* order 2: the id that last followed the two ids before;
* order 1: the id that last followed the id before;
* order 0: a distribution over all ids. The ids in ascending order are cut into
  groups of about equal frequency; the groups' shares start as the table has them
  and adapt within the block, an id's share of its group is the table's.

The chance that the order-2 prediction is right mixes two adaptive estimates,
one by the confidence of both predictions and one by the recent outcomes; the
mixing weight follows whichever has been better. The groups' distribution is
taken anew from their (ageing) counts every ``REFRESH`` ids. An interval of
``ONE`` is split into "order 2 is right", "order 1 is right" and the groups; an
id's interval within its group follows. All arithmetic is on integers, so
decoding repeats it.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES, SHORTEST, LONGEST = 2048, 512, 2048
MAGIC = b"TKCM\x02"

_BITS = 16
ONE = 1 << _BITS
REFRESH, _AGE = 16, 4096   # steps between distributions; counts are halved above
GROUPS, _START = 32, 2048  # groups of order 0; what their counts add up to at first
_SLOTS1, _SLOTS2 = 10, 11  # log2 of the prediction slots of a block
_MOST2, _MOST1 = ONE - (ONE >> 4), ONE - (ONE >> 2)
_U = np.uint64
_LOW32 = _U(0xFFFFFFFF)


class _Table:
    """The distinct ids of a file in ascending order, their frequencies and groups."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray):
        self.ids, self.freq = ids.astype(np.int64), freq.astype(np.int64)
        self.upto = np.concatenate([[0], np.cumsum(self.freq)])
        middle = self.upto[:-1] + self.freq // 2
        _, first, self.group = np.unique(middle * GROUPS // self.upto[-1], return_index=True, return_inverse=True)
        self.begin = self.upto[first]
        self.total = np.diff(np.append(self.begin, self.upto[-1]))
        self.start = np.maximum(self.total * _START // self.upto[-1], 1).astype(np.int32)

    def pack(self) -> bytes:
        raw = zlib.compress(np.diff(self.ids, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
                            + self.freq.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 6)
        return struct.pack("<II", len(self.ids), len(raw)) + raw

    @classmethod
    def unpack(cls, raw: bytes, at: int) -> tuple["_Table", int]:
        n, size = struct.unpack_from("<II", raw, at)
        planes = np.frombuffer(zlib.decompress(raw[at + 8:at + 8 + size]), np.uint8).reshape(2, 4, n)
        step, freq = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]
        return cls(np.cumsum(step.astype(np.int64)), freq), at + 8 + size


class _Model:
    """Adaptive state of all blocks; ``start`` are the counts of order 0's groups at first."""

    def __init__(self, lanes: int, start: np.ndarray):
        kinds = self.kinds = len(start)
        n = lanes
        self.row1 = np.arange(n, dtype=np.int64) << _SLOTS1
        self.row2 = np.arange(n, dtype=np.int64) << _SLOTS2
        self.row32, self.row8 = np.arange(n) * 32, np.arange(n) * 8
        self.after1 = np.zeros(n << _SLOTS1, np.int64)  # id * 4 + confidence
        self.after2 = np.zeros(n << _SLOTS2, np.int64)
        self.right2 = np.full(n * 32, ONE // 4, np.int32)
        self.right1 = np.full(n * 32, ONE // 8, np.int32)
        self.recent2 = np.full(n * 8, ONE // 4, np.int32)
        self.weight = np.full(n, ONE // 2, np.int32)
        self.history = np.zeros(n, np.int64)
        self.count = np.tile(start, (n, 1))
        self.cdf = np.zeros((n, kinds + 1), np.int32)  # in units of ONE / 4
        self.steps = np.arange(kinds + 1, dtype=np.int32)
        self.flat, self.cell = np.arange(n) * (kinds + 1), np.arange(n) * kinds
        self.c1 = self.c2 = np.zeros(n, np.int64)
        self.time = 0
        self._refresh()

    def _refresh(self) -> None:
        sums = np.cumsum(self.count, axis=1)
        self.cdf[:, 1:] = (sums << (_BITS - 2)) // sums[:, -1:]
        old = sums[:, -1] > _AGE
        self.count[old] = (self.count[old] + 1) >> 1

    def predict(self):
        """``(p2, p1, h2, h12)``: predicted ids and the ends of their intervals."""
        self.i1 = self.row1 + ((self.c1 * 40503 >> 4) & ((1 << _SLOTS1) - 1))
        self.i2 = self.row2 + (((self.c1 * 2654435761 + self.c2 * 40503 * 7) >> 11) & ((1 << _SLOTS2) - 1))
        self.e1, self.e2 = self.after1[self.i1], self.after2[self.i2]
        p1, p2 = self.e1 >> 2, self.e2 >> 2
        same = p1 == p2
        self.a = self.row32 + ((self.e2 & 3) << 2) + (self.e1 & 3) + (same << 4)
        self.b = self.row8 + self.history
        self.x, self.y = self.right2[self.a], self.recent2[self.b]
        h2 = self.y + ((self.x - self.y) * (self.weight >> 2) >> (_BITS - 2))
        h2 = np.minimum(np.maximum(h2, 64), _MOST2)
        self.z = self.right1[self.a]
        h1 = np.maximum(((ONE - h2) >> 2) * np.minimum(self.z, _MOST1) >> (_BITS - 2), 32)
        h1[same] = 0
        return p2, p1, h2, h2 + h1

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, kind: np.ndarray) -> None:
        goal = hit2 * np.int32(ONE)
        x, y = goal - self.x, goal - self.y
        self.right2[self.a] += x >> 4
        self.recent2[self.b] += y >> 4
        self.weight += np.where(np.abs(x) < np.abs(y), ONE - self.weight, -self.weight) >> 6
        miss = np.flatnonzero(~hit2)
        z = self.z[miss]
        self.right1[self.a[miss]] += (hit1[miss] * np.int32(ONE) - z) >> 4
        self.history = ((self.history << 1) & 7) | hit2
        for table, slot, entry in ((self.after1, self.i1, self.e1), (self.after2, self.i2, self.e2)):
            right = (entry >> 2) == ids
            table[slot] = np.where(right, entry + ((entry & 3) < 3), ids << 2)
        none = np.flatnonzero(kind >= 0)  # neither prediction was right
        self.count.ravel()[self.cell[none] + kind[none]] += 4
        self.c2, self.c1 = self.c1, ids
        self.time += 1
        if self.time % REFRESH == 0:
            self._refresh()

    def bounds(self, rest: np.ndarray, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Offset of a group in the rest of the interval, at least 1 wide each."""
        return kind + ((rest - self.kinds) * self.cdf.ravel()[self.flat[at] + kind] >> (_BITS - 2))

    def find(self, rest: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        edges = ((rest - self.kinds).astype(np.int32)[:, None] * self.cdf[at, 1:-1] >> (_BITS - 2)) + self.steps[1:-1]
        return (edges <= value[:, None]).sum(1, dtype=np.int64)


def _shape(n: int) -> tuple[int, int]:
    """``(length, blocks)``: all blocks but the last have ``length`` ids."""
    length = int(np.clip(-(-n // LANES), SHORTEST, LONGEST))
    return length, max(1, -(-n // length))


def encode(ids: np.ndarray) -> bytes:
    """Blocks of ids below 2^31, with their sizes and checksums."""
    n = len(ids)
    length, lanes = _shape(n)
    found, number, freq = np.unique(ids, return_inverse=True, return_counts=True)
    table = _Table(found, freq) if n else _Table(np.zeros(1), np.ones(1))
    grid = np.zeros(lanes * length, np.int64)  # the last block goes on with the smallest id
    grid[:n] = number
    grid = np.ascontiguousarray(grid.reshape(lanes, length).T)
    model = _Model(lanes, table.start)
    low, rng = np.zeros(lanes, _U), np.full(lanes, ~_U(0))
    cap = 2 * length + 4
    out, used = np.empty(lanes * cap, np.uint32), np.arange(lanes) * cap

    def emit():
        at = np.flatnonzero(rng <= _LOW32)
        if len(at):
            a, r = low[at], rng[at]
            over = ((a ^ (a + r - _U(1))) >> _U(32)) != 0  # keep the interval below a multiple of 2^32
            r = np.where(over, (_LOW32 + _U(1)) - (a & _LOW32), r)
            out[used[at]] = a >> _U(32)
            used[at] += 1
            low[at], rng[at] = a << _U(32), r << _U(32)

    for t in range(length):
        number = grid[t]
        x = table.ids[number]
        p2, p1, h2, h12 = model.predict()
        hit2 = x == p2
        hit1 = (x == p1) & ~hit2
        begin, end = np.where(hit2, 0, h2).astype(np.int64), np.where(hit2, h2, h12).astype(np.int64)
        kind = np.where(hit2 | hit1, -1, table.group[number])
        at = np.flatnonzero(kind >= 0)
        k, base = kind[at], h12[at]
        rest = ONE - base
        begin[at] = base + model.bounds(rest, at, k)
        end[at] = base + model.bounds(rest, at, k + 1)
        r = rng >> _U(_BITS)
        low += r * begin.astype(_U)
        rng = r * (end - begin).astype(_U)
        emit()
        own = number[at]
        r = rng[at] // table.total[k].astype(_U)
        low[at] += r * (table.upto[own] - table.begin[k]).astype(_U)
        rng[at] = r * table.freq[own].astype(_U)
        emit()
        model.update(x, hit2, hit1, kind)
    for _ in range(2):
        out[used] = low >> _U(32)
        used += 1
        low <<= _U(32)
    start = np.arange(lanes) * cap
    sizes = (used - start).astype("<u4")
    body = b"".join(out[a:b].astype("<u4").tobytes() for a, b in zip(start, used))
    raw = np.ascontiguousarray(ids.astype("<u4"))
    sums = np.array([zlib.crc32(raw[k * length:(k + 1) * length]) for k in range(lanes)], "<u4")
    return MAGIC + struct.pack("<III", n, length, lanes) + table.pack() + sizes.tobytes() + sums.tobytes() + body


def decode(raw: bytes) -> np.ndarray:
    """The ids of ``encode``; raises if a block's checksum does not fit."""
    head = len(MAGIC) + 12
    if raw[:len(MAGIC)] != MAGIC:
        raise ValueError("not a block of token ids")
    n, length, lanes = struct.unpack("<III", raw[len(MAGIC):head])
    table, head = _Table.unpack(raw, head)
    sizes = np.frombuffer(raw, "<u4", lanes, head).astype(np.int64)
    sums = np.frombuffer(raw, "<u4", lanes, head + 4 * lanes)
    words = np.frombuffer(raw, "<u4", offset=head + 8 * lanes).astype(_U)
    words = np.append(words, np.zeros(1, _U))
    stop = np.cumsum(sizes)
    at_word = stop - sizes
    model = _Model(lanes, table.start)
    low, rng = np.zeros(lanes, _U), np.full(lanes, ~_U(0))
    code = (words[at_word] << _U(32)) | words[at_word + 1]
    at_word += 2

    def fill():
        nonlocal code
        at = np.flatnonzero(rng <= _LOW32)
        if len(at):
            a, r = low[at], rng[at]
            over = ((a ^ (a + r - _U(1))) >> _U(32)) != 0
            r = np.where(over, (_LOW32 + _U(1)) - (a & _LOW32), r)
            code[at] = (code[at] << _U(32)) | words[np.minimum(at_word[at], len(words) - 1)]
            at_word[at] += 1
            low[at], rng[at] = a << _U(32), r << _U(32)

    grid = np.empty((length, lanes), np.int64)
    for t in range(length):
        p2, p1, h2, h12 = model.predict()
        r = rng >> _U(_BITS)
        value = np.minimum((code - low) // r, _U(ONE - 1)).astype(np.int32)
        hit2 = value < h2
        hit1 = (value < h12) & ~hit2
        x = np.where(hit2, p2, p1)
        begin, end = np.where(hit2, 0, h2).astype(np.int64), np.where(hit2, h2, h12).astype(np.int64)
        kind = np.full(lanes, -1)
        at = np.flatnonzero(value >= h12)
        base = h12[at]
        rest = ONE - base
        k = model.find(rest, at, value[at] - base)
        kind[at] = k
        begin[at] = base + model.bounds(rest, at, k)
        end[at] = base + model.bounds(rest, at, k + 1)
        low += r * begin.astype(_U)
        rng = r * (end - begin).astype(_U)
        fill()
        total = table.total[k]
        r = rng[at] // total.astype(_U)
        part = np.minimum(((code[at] - low[at]) // r).astype(np.int64), total - 1) + table.begin[k]
        own = np.searchsorted(table.upto, part, side="right") - 1
        low[at] += r * (table.upto[own] - table.begin[k]).astype(_U)
        rng[at] = r * table.freq[own].astype(_U)
        fill()
        x[at] = table.ids[own]
        grid[t] = x
        model.update(x, hit2, hit1, kind)
    ids = grid.T.ravel()[:n].astype("<u4")
    for k in range(lanes):
        if zlib.crc32(ids[k * length:(k + 1) * length]) != sums[k]:
            raise ValueError(f"checksum of block {k} does not fit")
    return ids
