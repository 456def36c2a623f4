"""Re-Pair grammars over token ids: frequent pairs become nonterminals, any range of ids can be read back.

A shard is one block of bytes, all numbers little-endian:

* ``RPG1``, then six 64-bit numbers: ids, symbols, rules, terminals (ids below it stand for themselves), bits of a symbol,
  symbols between two marks;
* the rules' left and right symbols, a rule's two symbols stand before any rule that uses it, in ``bits`` bits each;
* the rules' expansion lengths (unsigned 32-bit), then the ids before every mark of the sequence (unsigned 64-bit);
* the symbols of the sequence, in ``bits`` bits each.

A symbol below ``terminals`` is an id, ``terminals + r`` is rule r.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"RPG1"
HEAD = struct.Struct("<4s6Q")
LEAST = 4  # occurrences that a rule must replace
SHARE = 64  # a round takes pairs with at least so small a part of the most frequent pair's count
BITS = 18  # of the hash by which a round counts pairs
GAIN = 0.03  # rounds end when one removes a smaller part of the symbols
ROUNDS = 64
MARK = 256  # symbols between two marks


def packed(numbers: np.ndarray, bits: int) -> bytes:
    """Whole numbers below 2^bits as a string of bits, the lowest bit first."""
    out = []
    for i in range(0, len(numbers), 1 << 16):  # eight numbers end at a byte
        part = numbers[i:i + (1 << 16)].astype("<u8") & np.uint64((1 << bits) - 1)
        rows = -(-len(part) // 8)
        body = np.zeros((rows, bits + 8), np.uint8)  # eight numbers a row, and room for the last one's 64 bits
        for r in range(8):
            own = part[r::8]
            np.ndarray(len(own), "<u8", body, r * bits // 8, (bits + 8,))[:] |= own << np.uint64(r * bits % 8)
        out.append(body[:, :bits].tobytes()[:-(-len(part) * bits // 8)])
    return b"".join(out)


def unpacked(body: memoryview, bits: int, start: int, stop: int) -> np.ndarray:
    """Numbers ``start`` to ``stop`` of such a string."""
    if stop <= start:
        return np.zeros(0, np.int64)
    first = start * bits // 8
    read = np.concatenate([np.frombuffer(body[first:-(-stop * bits // 8)], np.uint8), np.zeros(8, np.uint8)])
    out = np.empty(stop - start, np.int64)
    for r in range(min(8, len(out))):  # every eighth number begins at the same bit of a byte
        byte, bit = divmod((start + r) * bits - 8 * first, 8)
        own = np.ndarray(len(out[r::8]), "<u8", read, byte, (bits,))
        out[r::8] = (own >> np.uint64(bit)) & np.uint64((1 << bits) - 1)
    return out


@dataclass
class Grammar:
    """A sequence of symbols with the rules that expand them."""

    terminals: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray


def _winners(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, rank) of pairs to replace: frequent ones, and the more frequent of two that overlap.

    Pairs are counted by a hash of ``BITS`` bits; of several that share it one is taken, the rest wait for a later round.  Of
    equal neighbours (a run of one symbol) those at odd places win.
    """
    own = symbols.view(np.uint32)
    name = own[:-1] * np.uint32(0x9E3779B1)
    name += own[1:] * np.uint32(0x85EBCA77)
    name >>= np.uint32(32 - BITS)
    name = name.astype(np.intp)
    counts = np.bincount(name, minlength=1 << BITS)
    often = np.flatnonzero(counts >= max(least, int(counts.max()) // SHARE))
    ranks = np.zeros(1 << BITS, np.int32)
    ranks[often[np.argsort(counts[often], kind="stable")]] = 2 * np.arange(1, len(often) + 1, dtype=np.int32)
    weight = np.zeros(len(name) + 2, np.int32)
    np.take(ranks, name, out=weight[1:-1], mode="clip")  # the default mode copies what it gives
    weight[2:-1:2] |= weight[2:-1:2] > 0
    own = weight[1:-1]
    at = np.flatnonzero((own > weight[:-2]) & (own > weight[2:]))
    rank = own[at] >> 1
    first = np.zeros(len(often) + 1, np.int64)
    first[rank] = at
    same = (symbols[at] == symbols[first[rank]]) & (symbols[at + 1] == symbols[first[rank] + 1])
    return at[same], rank[same]


def compressed(ids: np.ndarray, terminals: int, least: int = LEAST, gain: float = GAIN) -> Grammar:
    """Replace frequent pairs by nonterminals, round by round, until a round gains next to nothing.

    Each round counts all neighbouring pairs, and replaces those that occur ``least`` times and at least 1/64 as often as
    the most frequent one; where two overlap the more frequent one stays.  A rule that would replace fewer than ``least``
    occurrences after that is not made.
    """
    symbols = ids.astype(np.int32)
    left, right, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.ones(terminals, np.int64)
    for _ in range(ROUNDS):
        if len(symbols) < 2 * least:
            break
        at, rank = _winners(symbols, least)
        used = np.bincount(rank, minlength=1)
        made = used >= least
        if not made.any():
            break
        number = np.where(made, len(lengths) + np.cumsum(made) - 1, -1)[rank]
        at, number = at[number >= 0], number[number >= 0]
        where = np.zeros(int(made.sum()), np.int64)
        where[number - len(lengths)] = at
        left.append(symbols[where].astype(np.int64)), right.append(symbols[where + 1].astype(np.int64))
        lengths = np.concatenate([lengths, lengths[left[-1]] + lengths[right[-1]]])
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols[at] = number
        before, symbols = len(symbols), symbols[keep]
        if len(at) < gain * before:
            break
    return Grammar(terminals, np.concatenate(left), np.concatenate(right), lengths[terminals:], symbols.astype(np.int64))


def to_bytes(grammar: Grammar) -> bytes:
    total = grammar.terminals + len(grammar.left)
    bits = max(1, int(total - 1).bit_length())
    sizes = np.concatenate([np.ones(grammar.terminals, np.int64), grammar.lengths])[grammar.symbols]
    after = np.concatenate([[0], np.cumsum(sizes)])
    return b"".join([
        HEAD.pack(MAGIC, int(after[-1]), len(grammar.symbols), len(grammar.left), grammar.terminals, bits, MARK),
        packed(np.concatenate([grammar.left, grammar.right]), bits), grammar.lengths.astype("<u4").tobytes(),
        after[:-1][::MARK].astype("<u8").tobytes(), packed(grammar.symbols, bits),
    ])


class Shard:
    """A shard's bytes, to be read in whole or in part."""

    def __init__(self, body: bytes):
        self.body = memoryview(body)
        magic, self.ids, self.symbols, self.rules, self.terminals, self.bits, self.mark = HEAD.unpack_from(self.body)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = HEAD.size
        both = unpacked(self.body[at:], self.bits, 0, 2 * self.rules)
        self.left, self.right = both[:self.rules], both[self.rules:]
        at += -(-2 * self.rules * self.bits // 8)
        self.lengths = np.concatenate([np.ones(self.terminals, np.int64), np.frombuffer(self.body, "<u4", self.rules, at).astype(np.int64)])
        at += 4 * self.rules
        marks = -(-self.symbols // self.mark)
        self.marks = np.frombuffer(self.body, "<u8", marks, at).astype(np.int64)
        self.at = at + 8 * marks
        self.flat: np.ndarray | None = None

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of symbols; all rules are opened once if there are many symbols, else those at hand, level by level."""
        if len(symbols) > 4 * self.rules:
            if self.flat is None:
                self.flat = np.concatenate([np.arange(self.terminals), self._opened(self.terminals + np.arange(self.rules))])
                self.first = np.cumsum(self.lengths) - self.lengths
            sizes = self.lengths[symbols]
            after = np.cumsum(sizes)
            total = int(after[-1])
            kind = np.int32 if max(total, len(self.flat)) < 1 << 30 else np.int64
            return self.flat[np.arange(total, dtype=kind) + np.repeat((self.first[symbols] - (after - sizes)).astype(kind), sizes)]
        return self._opened(symbols)

    def _opened(self, symbols: np.ndarray) -> np.ndarray:
        while True:
            inner = symbols >= self.terminals
            if not inner.any():
                return symbols
            sizes = 1 + inner
            ends = np.cumsum(sizes)
            out = np.empty(int(ends[-1]), np.int64)
            first = ends - sizes
            rule = symbols[inner] - self.terminals
            out[first[~inner]] = symbols[~inner]
            out[first[inner]], out[first[inner] + 1] = self.left[rule], self.right[rule]
            symbols = out

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the symbols that cover them are unpacked and opened.

        The marks lead near the first symbol, expansion lengths to the exact one; a rule that sticks out is opened
        towards the range only.
        """
        stop = self.ids if stop is None else min(stop, self.ids)
        if stop <= start:
            return np.zeros(0, np.int64)
        first = int(np.searchsorted(self.marks, start, "right")) - 1
        last = int(np.searchsorted(self.marks, stop, "left"))
        symbols = unpacked(self.body[self.at:], self.bits, first * self.mark, min(last * self.mark, self.symbols))
        ends = int(self.marks[first]) + np.cumsum(self.lengths[symbols])
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left"))
        begin = int(ends[a] - self.lengths[symbols[a]])
        return np.concatenate(list(self._ranges(symbols[a:b + 1], begin, start, stop)))

    def _ranges(self, symbols: np.ndarray, begin: int, start: int, stop: int):
        """Parts of the ids that ``symbols`` stand for, cut at both ends without opening what lies outside."""
        lengths = self.lengths[symbols]
        end = begin + int(lengths.sum())
        whole_from, whole_to = int(begin < start), len(symbols) - int(end > stop)
        if whole_from:
            yield self._cut(int(symbols[0]), start - begin, min(stop - begin, int(lengths[0])))
        if whole_to > whole_from:
            yield self._expanded(symbols[whole_from:whole_to])
        if end > stop and (len(symbols) > 1 or not whole_from):
            yield self._cut(int(symbols[-1]), 0, stop - (end - int(lengths[-1])))

    def _cut(self, symbol: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of one symbol."""
        parts, open_ = [], [(symbol, start, stop)]
        while open_:
            symbol, a, b = open_.pop()
            size = int(self.lengths[symbol])
            a, b = max(a, 0), min(b, size)
            if b <= a:
                continue
            if a == 0 and b == size:
                parts.append(self._expanded(np.array([symbol])))
                continue
            left, right = int(self.left[symbol - self.terminals]), int(self.right[symbol - self.terminals])
            middle = int(self.lengths[left])
            open_.append((right, a - middle, b - middle))
            open_.append((left, a, b))
        return np.concatenate(parts)
