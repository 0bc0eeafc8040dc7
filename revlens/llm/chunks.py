"""Encoding by distinct chunks: each chunk of text is tokenised once per
worker and its ids are joined back by position.

A tokeniser treats a text as a row of chunks that no piece crosses (a
marked word, a word). ``ChunkTable`` maps chunk hashes to id lists in a
vectorised open-addressing table; only chunks not met before reach the
tokeniser library. The table starts small and grows with the chunks met. When
half full at its full size it keeps the chunks met again since the last time,
at most half of what it may hold and those met last, and forgets the others:
its memory is bounded whatever the corpus, and frequent chunks stay.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Callable

import numpy as np

from revlens.llm import textscan

_EMPTY = np.uint64(0)


class ChunkTable:
    """chunk hash -> token ids, for one encode function; ``bits`` is its full size."""

    FIRST_BITS = 14

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], bits: int = 20) -> None:
        self.encode, self.full = encode, bits
        self.bits = min(bits, self.FIRST_BITS)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slot_value = np.zeros(1 << self.bits, dtype=np.int32)
        self.begin = np.zeros(1 << (self.bits - 1), dtype=np.int64)
        self.length = np.zeros(1 << (self.bits - 1), dtype=np.int32)
        self.flat = np.zeros(1 << self.bits, dtype=np.uint32)
        # the call at which a chunk was met again, 0 if never
        self.met = np.zeros(1 << (self.bits - 1), dtype=np.int32)
        self.held = self.used = self.calls = 0

    def _grow(self) -> None:
        """Twice the slots; what is held stays."""
        taken = np.flatnonzero(self.keys != _EMPTY)
        hashes, at = self.keys[taken], self.slot_value[taken]
        self.bits += 1
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slot_value = np.zeros(1 << self.bits, dtype=np.int32)
        self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self._place(hashes, at)

    def _forget(self) -> None:
        """Keep the chunks met again, at most half of what the table may hold."""
        taken = np.flatnonzero(self.keys != _EMPTY)
        at = self.slot_value[taken]
        again = np.flatnonzero(self.met[at])
        again = again[np.argsort(-self.met[at[again]], kind="stable")[: len(self.begin) // 2]]
        hashes, at = self.keys[taken[again]], at[again]
        length = self.length[at].astype(np.int64)
        flat = self.flat[textscan.gather_ranges(self.begin[at], length)]
        self._clear()
        self._add(hashes, flat, length)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where absent."""
        mask = (1 << self.bits) - 1
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        key = self.keys.take(slot)
        hit = key == hashes
        out = np.where(hit, self.slot_value.take(slot), -1).astype(np.int64)
        open_ = np.flatnonzero(~hit & (key != _EMPTY))
        hashes, slot = hashes.take(open_), (slot.take(open_) + 1) & mask
        while len(open_):
            key = self.keys.take(slot)
            hit = key == hashes
            out[open_[hit]] = self.slot_value[slot[hit]]
            more = np.flatnonzero(~hit & (key != _EMPTY))
            open_, hashes, slot = open_.take(more), hashes.take(more), (slot.take(more) + 1) & mask
        return out

    def _insert(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        n = np.array([len(x) for x in ids], dtype=np.int64)
        self._add(hashes, np.fromiter(itertools.chain.from_iterable(ids), dtype=np.uint32, count=int(n.sum())), n)

    def _add(self, hashes: np.ndarray, flat: np.ndarray, n: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(flat)] = flat
        at = np.arange(self.held, self.held + len(n))
        self.begin[at] = self.used + np.cumsum(n) - n
        self.length[at] = n
        self.held += len(n)
        self.used += len(flat)
        self._place(hashes, at)

    def _place(self, hashes: np.ndarray, at: np.ndarray) -> None:
        """Slots for hashes that the table does not hold."""
        mask = (1 << self.bits) - 1
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(at):
            free = self.keys[slot] == _EMPTY
            self.keys[slot[free]] = hashes[free]  # of several at one slot the last stays
            won = free & (self.keys[slot] == hashes)
            self.slot_value[slot[won]] = at[won]
            at, hashes, slot = at[~won], hashes[~won], (slot[~won] + 1) & mask

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after another, number of ids of each chunk)."""
        hashes = np.where(hashes == _EMPTY, np.uint64(1), hashes)
        found = self._find(hashes)
        missing = np.flatnonzero(found < 0)
        self.calls += 1
        self.met[found[found >= 0] if len(missing) else found] = self.calls
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            while self.held + len(new) > len(self.begin) and self.bits < self.full:
                self._grow()
            if self.held + len(new) > len(self.begin):
                self._forget()
                missing = np.flatnonzero(self._find(hashes) < 0)
                new, at = np.unique(hashes[missing], return_index=True)
            if self.held + len(new) > len(self.begin):
                self._clear()
                new, at = np.unique(hashes, return_index=True)
                missing = np.arange(len(hashes))
                while len(new) > len(self.begin):  # one slice with more chunks than the table holds
                    self.bits += 1
                    self.full = max(self.full, self.bits)
                    self._clear()
            first = missing[at]
            self._insert(new, self.encode([data[s:e].tobytes() for s, e in zip(start[first].tolist(), end[first].tolist())]))
            found = self._find(hashes)
        length = self.length[found].astype(np.int64)
        return self.flat[textscan.gather_ranges(self.begin[found], length)], length


# Kinds of bytes, as bits, so that one pass over the bytes tells them all.
_IS_SPACE, _IS_SPACELIKE, _IS_LETTER, _IS_MARK, _IS_HIGH = 1, 2, 4, 8, 16
_SPACELIKE = np.zeros(256, dtype=bool)
_SPACELIKE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_TAIL_85_A0 = np.zeros(256, dtype=bool)
_TAIL_85_A0[[0x85, 0xA0]] = True


_KINDS = (
    textscan._SPACE * _IS_SPACE + _SPACELIKE * _IS_SPACELIKE + _LETTER * _IS_LETTER + _MARK * _IS_MARK + (np.arange(256) >= 0x80) * _IS_HIGH
).astype(np.uint8).tobytes()


def _back(data: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(data)
    out[by:] = data[:-by]
    return out


def _wide_space_before(data: np.ndarray) -> np.ndarray:
    """True where the bytes before may end a white-space character outside ASCII."""
    one, two, three = _back(data, 1), _back(data, 2), _back(data, 3)
    narrow = (two == 0xC2) & _TAIL_85_A0[one]
    wide = (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A)) & (one >= 0x80)
    return narrow | wide


def _spans(text: textscan.Text, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunk starts, ends, first chunk of each row) for cuts before the marked bytes."""
    if not len(text.data):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(text.rows + 1, dtype=np.int64)
    cut[text.offsets[:-1][text.offsets[:-1] < len(cut)]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(text.data)), np.searchsorted(start, text.offsets)


def spaced_words(text: textscan.Text):
    """Chunks for byte-level BPE: a cut before white space that follows
    something else, and between an ASCII letter and an ASCII mark. The
    splitting pattern starts anew at both, wherever they stand."""
    data = text.data
    kind = np.frombuffer(data.tobytes().translate(_KINDS), dtype=np.uint8)
    before = _back(kind, 1)
    opens = ((kind & _IS_SPACE) != 0) & ((before & _IS_SPACELIKE) == 0)
    cut = opens | (((before & _IS_LETTER) != 0) & ((kind & _IS_MARK) != 0))
    # only a byte outside ASCII can end a wider white-space character
    at = np.flatnonzero(opens & ((before & _IS_HIGH) != 0))
    if len(at):
        three = np.stack([data[np.maximum(at - by, 0)] * (at >= by) for by in (3, 2, 1)] + [data[at]], axis=1).astype(np.uint8)
        cut[at] = ~_wide_space_before(three.reshape(-1)).reshape(-1, 4)[:, 3]
    return _spans(text, cut)


def bare_words(text: textscan.Text):
    """Chunks for word-end BPE that drops white space: words, marks apart."""
    data = text.data
    before = _back(data, 1)
    space = textscan._SPACE[data]
    row = np.zeros(len(data) + 1, dtype=bool)
    row[text.offsets] = True
    opens = ~space & (textscan._SPACE[before] | row[:-1] | (_LETTER[before] & _MARK[data]))
    if len(opens):
        opens[0] = not space[0]
    start = np.flatnonzero(opens)
    nxt = np.ones(len(data) + 1, dtype=bool)
    nxt[:-1] = space | opens | row[:-1]
    stops = np.flatnonzero(nxt)
    end = stops[np.searchsorted(stops, start, side="right")]
    return start, end, np.searchsorted(start, text.offsets)


def marked_words(text: textscan.Text):
    """Chunks for sentencepiece: a cut before a space that follows neither a
    space nor a literal marker (U+2581)."""
    data = text.data
    one, two, three = _back(data, 1), _back(data, 2), _back(data, 3)
    cut = (data == 32) & (one != 32) & ~((one == 0x81) & (two == 0x96) & (three == 0xE2))
    return _spans(text, cut)


# One piece of the byte-level splitting pattern: letters that every version of Unicode counts as such.
_PLAIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+").fullmatch
# The character by which byte-level BPE names each byte: the printed ones by themselves. (A line end stands between chunks.)
_BYTE_NAMES = np.arange(256, dtype="<u4")
_UNPRINTED = np.array([*range(33), *range(127, 161), 173])
_BYTE_NAMES[_UNPRINTED] = 256 + np.arange(len(_UNPRINTED))
_BYTE_NAMES[10] = 10


def _byte_level(library) -> bool:
    """Whether the library splits by the byte-level pattern and changes nothing else."""
    if any(x is not None for x in (library.normalizer, library.truncation, library.padding)) or library.pre_tokenizer is None:
        return False
    split = json.loads(library.pre_tokenizer.__getstate__())
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    return plain and all(t.special for t in library.get_added_tokens_decoder().values())


def row_lengths(first: np.ndarray, per_chunk: np.ndarray) -> np.ndarray:
    """Ids of each row, from the ids of each chunk."""
    total = np.zeros(len(per_chunk) + 1, dtype=np.int64)
    np.cumsum(per_chunk, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


class JsonTokenizer:
    """A file of the ``tokenizers`` library, encoded by distinct chunks.

    With ``added`` the ids are those of the library as its file sets it up:
    an added token written in a text is its one id, and the text on either
    side is encoded on its own. Without, its string is ordinary text.
    """

    def __init__(self, path: str, chunks: Callable, lower: bool = False, added: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        found = self.library.get_added_tokens_decoder() if added else {}
        # tokens that take in white space or are looked up in changed text: rows go to the library whole
        self.whole = any(not t.special or t.normalized or t.lstrip or t.rstrip or t.single_word for t in found.values())
        self.library.encode_special_tokens = not self.whole  # in a chunk their strings are ordinary text
        self.added = {t.content.encode(): i for i, t in found.items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.chunks, self.lower = chunks, lower
        # a chunk that is one piece goes to the library's model at once
        self.pieces = self.library.model.tokenize if not self.whole and _byte_level(self.library) else None
        self.table = ChunkTable(self._encode)

    def _encode(self, found: list[bytes]) -> list[list[int]]:
        if not self.pieces:
            return self._library(found)
        plain = [_PLAIN(x.decode("utf-8", "replace")) is not None for x in found]
        joined = np.frombuffer(b"\n".join(itertools.compress(found, plain)), dtype=np.uint8)
        names = _BYTE_NAMES[joined].tobytes().decode("utf-32-le").split("\n")
        others = iter(self._library([x for x, p in zip(found, plain) if not p]))
        named, pieces = iter(names), self.pieces
        return [[t.id for t in pieces(next(named))] if p else next(others) for p in plain]

    def _library(self, found: list[bytes]) -> list[list[int]]:
        many = getattr(self.library, "encode_batch_fast", self.library.encode_batch)
        out: list[list[int]] = []
        for at in range(0, len(found), 4096):
            part = [x.decode("utf-8", "replace") for x in found[at : at + 4096]]
            out += [e.ids for e in many(part, add_special_tokens=False)]
        return out

    def _added(self, text: textscan.Text) -> np.ndarray:
        """(start, end, id) of the added tokens in the rows, leftmost and longest first."""
        raw = text.data.tobytes() if self.pattern else b""
        found = []
        if self.pattern and self.pattern.search(raw):
            for s, e in zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist()):
                found += [(*m.span(), self.added[m[0]]) for m in self.pattern.finditer(raw, s, e)]
        return np.array(found, dtype=np.int64).reshape(-1, 3)

    def rows(self, text: textscan.Text) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each row)."""
        if self.whole:
            every = self._encode([text.data[s:e].tobytes() for s, e in zip(text.offsets[:-1].tolist(), text.offsets[1:].tolist())])
            return np.array([x for ids in every for x in ids], dtype=np.uint32), np.array([len(x) for x in every], dtype=np.int64)
        added = self._added(text)
        # what stands between added tokens is chunked like rows of their own
        start, end, first = self.chunks(text._replace(offsets=np.sort(np.concatenate([text.offsets, added[:, 0], added[:, 1]]))))
        if len(added):
            at = np.searchsorted(added[:, 0], start, side="right") - 1
            between = (at < 0) | (start >= added[at, 1])
            start, end = start[between], end[between]
            first = np.searchsorted(start, text.offsets)
        data = textscan.lower_ascii(text).data if self.lower else text.data
        ids, per_chunk = self.table.ids(data, start, end, textscan.span_hash(data, start, end))
        lengths = row_lengths(first, per_chunk)
        if len(added):
            before = np.append(0, np.cumsum(per_chunk))
            ids = np.insert(ids, before[np.searchsorted(start, added[:, 0])], added[:, 2])
            lengths = lengths + np.diff(np.searchsorted(added[:, 0], text.offsets))
        return ids, lengths


_HELD: dict[tuple, object] = {}


def held(kind: Callable, *args):
    """One tokeniser per worker process, kept from task to task."""
    key = (kind, *args)
    if key not in _HELD:
        _HELD[key] = kind(*args)
    return _HELD[key]
