"""Adaptive context-mixing range coder for token ids, vectorised over lanes.

A block's ids are cut into equal lanes that are coded side by side, one
numpy step for all lanes, under one shared model that starts empty. For
each id the model mixes three experts: the id seen last after the two
ids before (order 2), the one after the id before (order 1), and adaptive
frequencies (order 0). The mixing weights are learned for each pair of
the predictions' confidences. An id that neither prediction hits is coded
by order 0.

The decoder repeats the same updates, so nothing but the code words is
stored. Blocks are independent of each other and carry a checksum over
ids and code words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

U = np.uint64
_LOW32 = U(0xFFFFFFFF)
_ORDER0_BITS = 20
_CLASS_BITS = 16
_TABLE_BITS = 18
_MAX_LANES = 4096
_LANE_STEPS = 256
_REFRESH = 64
_HEAD = struct.Struct("<4sIIII")
_MAGIC = b"CMR1"


class _Model:
    def __init__(self, vocab: int, lanes: int) -> None:
        self.vocab = vocab
        # a cell holds the guess and, in its lowest three bits, how sure it is
        self.table2 = np.zeros(1 << _TABLE_BITS, dtype=np.int32)
        self.table1 = np.zeros(vocab + 1, dtype=np.int32)
        self.shares = np.tile(np.array([4, 2, 8], dtype=np.int64), (128, 1))
        self.counts = np.zeros(vocab, dtype=np.int64)
        self.seen: list[np.ndarray] = []
        self.cells: list[np.ndarray] = []
        self.before1 = np.full(lanes, vocab, dtype=np.int32)
        self.before2 = np.full(lanes, vocab, dtype=np.int32)
        self._order0()
        self._weights()

    def _order0(self) -> None:
        free = (1 << _ORDER0_BITS) - self.vocab
        self.freq0 = 1 + self.counts * free // max(int(self.counts.sum()), 1)
        self.cum0 = np.concatenate([[0], np.cumsum(self.freq0)])
        self.at0 = None

    def find0(self, spot: np.ndarray) -> np.ndarray:
        """The id at each place of the order-0 frequencies (beyond them: the last id)."""
        if self.at0 is None:
            small = np.uint16 if self.vocab <= 1 << 16 else np.int32
            self.at0 = np.empty(1 << _ORDER0_BITS, dtype=small)
            self.at0[: self.cum0[-1]] = np.repeat(np.arange(self.vocab, dtype=small), self.freq0)
            self.at0[self.cum0[-1] :] = self.vocab - 1
        return self.at0.take(spot).astype(np.int64)

    def _weights(self) -> None:
        free = (1 << _CLASS_BITS) - 3
        self.freq = 1 + self.shares * free // self.shares.sum(axis=1, keepdims=True)
        ends = np.cumsum(self.freq, axis=1)
        self.end0, self.end1 = ends[:, 0].astype(U), ends[:, 1].astype(U)
        # by cell: kind * 128 + context
        self.cell_begin = (ends - self.freq).T.reshape(-1).astype(U)
        self.cell_freq = self.freq.T.reshape(-1).astype(U)

    def predict(self, k: int):
        """(place, cell, how sure it is) of order 2 and of order 1, and the mixing context, of the first k lanes."""
        one, two = self.before1[:k], self.before2[:k]
        # the low 32 bits hold all that the mask leaves
        mixed = one.view(np.uint32) * np.uint32(0x9E3779B1) + two.view(np.uint32) * np.uint32(0x85EBCA77)
        slot, at = ((mixed >> np.uint32(7)) & np.uint32((1 << _TABLE_BITS) - 1)).astype(np.int64), one.astype(np.int64)
        c2, c1 = self.table2.take(slot), self.table1.take(at)
        sure2, sure1 = (c2 & 7).astype(np.int8), (c1 & 7).astype(np.int8)
        context = sure2 * np.int8(8) + sure1 + ((c2 ^ c1) < 8).view(np.int8) * np.int8(64)
        return (slot, c2, sure2), (at, c1, sure1), context

    def update(self, k: int, step: int, ids, order2, order1, cell) -> None:
        first = ids * 8
        for table, (place, was, sure) in ((self.table2, order2), (self.table1, order1)):
            # a hit is surer by one (7 at most), a miss half as sure; an unsure guess gives way
            hit = (was ^ first) < 8
            half = (sure + np.int8(1)) >> np.int8(1)
            kept = was + (np.minimum(half + np.int8(1), np.int8(4)) * hit.view(np.int8) - half)
            table[place] = first + (kept - first) * (hit | (sure > 1)).astype(np.int32)
        self.cells.append(cell)
        if step < 16 or step % 8 == 0:
            self.shares += 32 * np.bincount(np.concatenate(self.cells), minlength=384).reshape(3, 128).T
            self.cells = []
            np.right_shift(self.shares, 1, out=self.shares, where=(self.shares.sum(axis=1) > 1 << 20)[:, None])
            np.maximum(self.shares, 1, out=self.shares)
            self._weights()
        self.seen.append(ids)
        if step & (step + 1) == 0 or step % _REFRESH == 0:
            self.counts += np.bincount(np.concatenate(self.seen), minlength=self.vocab)
            self.seen = []
            self._order0()
        self.before2[:k] = self.before1[:k]
        self.before1[:k] = ids


def _lanes(n: int) -> tuple[int, int]:
    lanes = min(max(n // _LANE_STEPS, 1), _MAX_LANES)
    return lanes, -(-n // lanes)


def _active(n: int, lanes: int, steps: int, step: int) -> int:
    """Lanes that still have an id at ``step`` (the last lanes may be shorter)."""
    return min(lanes, -(-(n - step) // steps)) if step < n else 0


def _cell(context, not2, both):
    return (context + (not2.view(np.int8) + both.view(np.int8)) * np.int16(128)).astype(np.int64)


def _narrow(low, r, begin, freq):
    """(low, range, lanes that put out a word, their low before): one symbol in every lane, ``r`` being its unit."""
    low = low + begin * r
    r = r * freq
    small = (r <= _LOW32).nonzero()[0]
    a = low.take(small)
    if len(small):
        # a range that crosses a word's end is cut there
        b = np.minimum(r.take(small), U(1 << 32) - (a & _LOW32))
        low[small], r[small] = a << U(32), b << U(32)
    return low, r, small, a


def encode(ids: np.ndarray, vocab: int) -> bytes:
    """One block: header, checksum and code words."""
    n = len(ids)
    plain = zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))
    if not n:
        return _HEAD.pack(_MAGIC, 0, vocab, plain, 0)
    lanes, steps = _lanes(n)
    padded = np.zeros(lanes * steps, dtype=np.int32)
    padded[:n] = ids
    grid = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = _Model(vocab, lanes)
    low, rng = np.zeros(lanes, dtype=U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=U)
    out_lane, out_word = [], []

    def put(at, begin, freq, bits: int) -> None:
        lo, r, small, a = _narrow(low[at], rng[at] >> U(bits), begin, freq)
        if len(small):
            out_lane.append((small if isinstance(at, slice) else at[small]).astype(np.uint16))
            out_word.append((a >> U(32)).astype("<u4"))
        low[at], rng[at] = lo, r

    for step in range(steps):
        k = _active(n, lanes, steps, step)
        now = grid[step, :k]
        order2, order1, context = model.predict(k)
        not2 = now != order2[1] >> 3
        both = not2 & (now != order1[1] >> 3)
        cell = _cell(context, not2, both)
        put(slice(0, k), model.cell_begin.take(cell), model.cell_freq.take(cell), _CLASS_BITS)
        miss = both.nonzero()[0]
        if len(miss):
            said = now[miss]
            put(miss, model.cum0.take(said).astype(U), model.freq0.take(said).astype(U), _ORDER0_BITS)
        model.update(k, step, now, order2, order1, cell)
    every = np.arange(lanes, dtype=np.uint16)
    out_lane += [every, every]
    out_word += [(low >> U(32)).astype("<u4"), (low & _LOW32).astype("<u4")]
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane, kind="stable")
    sizes = np.bincount(lane, minlength=lanes).astype("<u4")
    body = sizes.tobytes() + word.take(order).tobytes()
    return _HEAD.pack(_MAGIC, n, vocab, zlib.crc32(body, plain), len(word)) + body


def decode(block: bytes) -> np.ndarray:
    """The ids of one block; raises ValueError if it is damaged."""
    if len(block) < _HEAD.size:
        raise ValueError("token block: no header")
    magic, n, vocab, check, total = _HEAD.unpack_from(block)
    lanes, steps = _lanes(n) if n else (0, 0)
    if magic != _MAGIC or len(block) != _HEAD.size + 4 * (lanes + total):
        raise ValueError("token block: wrong header or length")
    ids = _decode(block, n, vocab, lanes, steps, total) if n else np.zeros(0, dtype=np.int32)
    if zlib.crc32(memoryview(block)[_HEAD.size :], zlib.crc32(ids.astype("<u4"))) != check:
        raise ValueError("token block: checksum does not fit")
    return ids


def _decode(block: bytes, n: int, vocab: int, lanes: int, steps: int, total: int) -> np.ndarray:
    sizes = np.frombuffer(block, dtype="<u4", count=lanes, offset=_HEAD.size).astype(np.int64)
    words = np.append(np.frombuffer(block, dtype="<u4", count=total, offset=_HEAD.size + 4 * lanes).astype(U), U(0))
    if int(sizes.sum()) != total:
        raise ValueError("token block: wrong lane sizes")
    at_word = np.cumsum(sizes) - sizes + 2
    code = (words[np.minimum(at_word - 2, total)] << U(32)) | words[np.minimum(at_word - 1, total)]
    low, rng = np.zeros(lanes, dtype=U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, dtype=U)
    model = _Model(vocab, lanes)
    grid = np.zeros((steps, lanes), dtype=np.int32)

    def take(at, lo, r, begin, freq) -> None:
        low[at], rng[at], small, _ = _narrow(lo, r, begin, freq)
        if len(small):
            lane = small if isinstance(at, slice) else at[small]
            spot = at_word[lane]
            code[lane] = (code[lane] << U(32)) | words.take(spot, mode="clip")
            at_word[lane] = spot + 1

    for step in range(steps):
        k = _active(n, lanes, steps, step)
        order2, order1, context = model.predict(k)
        place = context.astype(np.int64)
        lanes_k = slice(0, k)
        lo, r = low[lanes_k], rng[lanes_k] >> U(_CLASS_BITS)
        # as whole numbers, place >= end says the same as code - low >= end * unit
        spot = code[lanes_k] - lo
        not2, both = spot >= model.end0.take(place) * r, spot >= model.end1.take(place) * r
        cell = _cell(context, not2, both)
        take(lanes_k, lo, r, model.cell_begin.take(cell), model.cell_freq.take(cell))
        now = np.where(not2, order1[1], order2[1]) >> 3
        miss = both.nonzero()[0]
        if len(miss):
            lo, r = low.take(miss), rng.take(miss) >> U(_ORDER0_BITS)
            spot = np.minimum((code.take(miss) - lo) // r, U((1 << _ORDER0_BITS) - 1)).view(np.int64)
            found = model.find0(spot)
            now[miss] = found
            take(miss, lo, r, model.cum0.take(found).astype(U), model.freq0.take(found).astype(U))
        grid[step, :k] = now
        model.update(k, step, now, order2, order1, cell)
    return np.ascontiguousarray(grid.T).reshape(-1)[:n]
