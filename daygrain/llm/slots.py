"""Pieces of text as slots of a growing table, so that each distinct piece is worked on once by a worker."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np

from daygrain.llm.text import mixed

BLOCK = 1 << 18  # bytes cut into pieces at once
SHORT = 64  # longer pieces are never kept
KEPT = 1 << 21  # pieces a worker keeps

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << (8 * min(n, 8))) - 1 for n in range(9)], np.uint64)


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the first ``SHORT`` bytes and the length of each span, eight bytes at a time."""
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(body) + 1, "<u8", padded, strides=(1,))
    left = ends - starts
    out = mixed((eights[starts] & _MASKS[np.minimum(left, 8)]) + left.astype(np.uint64) * _STEP)
    more, at, left = np.flatnonzero(left > 8), starts + 8, left - 8
    for _ in range(SHORT // 8 - 1):
        if not len(more):
            break
        out[more] = mixed(out[more] * _STEP + (eights[at[more]] & _MASKS[np.minimum(left[more], 8)]))
        at, left = at + 8, left - 8
        more = more[left[more] > 0]
    return out


def blocks(body: np.ndarray, offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of ``body`` that end at a text's end or before a space; a longer word is a longer run."""
    at, n = 0, len(body)
    while at < n:
        end = min(at + limit, n)
        if end < n:
            text_end = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            spaces = np.flatnonzero(body[at + 1:end] == 0x20)
            end = max(text_end, at + 1 + int(spaces[-1]) if len(spaces) else at)
            if end <= at:
                end = int(offsets[np.searchsorted(offsets, at, "right")])
                for look in range(at + 1, end, limit):
                    spaces = np.flatnonzero(body[look:min(look + limit, end)] == 0x20)
                    if len(spaces):
                        end = look + int(spaces[0])
                        break
        yield at, end
        at = end


class Slots:
    """Numbers 0, 1, ... for 64-bit hashes, in the order of their arrival; an open table, half empty at least."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.used = 0
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.names, self.at = np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, or -1."""
        mask = len(self.at) - 1
        place = (hashes & np.uint64(mask)).astype(np.int64)
        out = self.at[place].astype(np.int64)
        rest = np.flatnonzero((out >= 0) & (self.names[place] != hashes))
        place = place[rest]
        while len(rest):
            place = (place + 1) & mask
            slot = self.at[place]
            out[rest] = slot
            wrong = (slot >= 0) & (self.names[place] != hashes[rest])
            rest, place = rest[wrong], place[wrong]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Give new distinct hashes the next slots."""
        while 2 * (self.used + len(hashes)) > len(self.at):
            names, slots = self.names[self.at >= 0], self.at[self.at >= 0]
            self._grow(2 * len(self.at))
            self._put(names, slots)
        self._put(hashes, np.arange(self.used, self.used + len(hashes), dtype=np.int32))
        self.used += len(hashes)

    def _put(self, hashes: np.ndarray, slots: np.ndarray) -> None:
        mask = len(self.at) - 1
        place = (hashes & np.uint64(mask)).astype(np.int64)
        while len(hashes):
            free = self.at[place] < 0
            self.at[place[free]], self.names[place[free]] = slots[free], hashes[free]  # the last of equal places wins
            lost = ~free | (self.at[place] != slots)
            hashes, slots, place = hashes[lost], slots[lost], (place[lost] + 1) & mask


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


_SIGNS = {b: c for c, b in byte_of_sign().items()}


def in_signs(words: list[bytes]) -> list[str]:
    """Words as a byte-level vocabulary writes them."""
    return [w.decode("latin-1").translate(_SIGNS) for w in words]


_WIDE_SIGNS = np.array([ord(_SIGNS[b]) for b in range(256)], "<u4")
_WIDE_SIGNS[0x0A] = 0x0A


def lines_in_signs(words: list[bytes]) -> list[str]:
    """``in_signs`` of words without line ends, all at once."""
    return _WIDE_SIGNS[np.frombuffer(b"\n".join(words), np.uint8)].tobytes().decode("utf-32-le").split("\n") if words else []


def decoded(words: list[bytes]) -> list[str]:
    """Words without line ends as text, all at once."""
    return b"\n".join(words).decode("utf-8", "replace").split("\n") if words else []


def whole_words(bare, words: list[str], closing: np.ndarray | None = None, group: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, ids of each) by a tokenizer that takes words as they are; groups spare an object a word.

    ``closing`` tells of each id whether it ends a word, if the vocabulary has such ids.
    """
    ids, sizes = [], []
    for i in range(0, len(words), group):
        part = words[i:i + group]
        if closing is not None:  # without offsets, which the plain call keeps
            ids.append(np.array(bare.encode_batch_fast([part], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int64))
            sizes.append(np.diff(np.flatnonzero(closing[ids[-1]]), prepend=-1))
        else:
            found = bare.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.int64))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)))
    none = [np.zeros(0, np.int64)]
    return np.concatenate(ids or none), np.concatenate(sizes or none)


def interleaved(first: np.ndarray, parts: tuple, others: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Two (ids, sizes) as one, where ``first`` marks the places of the first."""
    sizes = np.empty(len(first), np.int64)
    sizes[first], sizes[~first] = parts[1], others[1]
    mine = np.repeat(first, sizes)
    ids = np.empty(int(sizes.sum()), np.int64)
    ids[mine], ids[~mine] = parts[0], others[0]
    return ids, sizes


def flattened(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum())), sizes


class Runs:
    """Arrays of each slot, one after the other in one growing array."""

    def __init__(self, kind):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.body, self.used = np.empty(1 << 12, self.kind), 0
        self.first, self.size, self.count = np.empty(1 << 10, np.int64), np.empty(1 << 10, np.int32), 0

    def append(self, sizes: np.ndarray, body: np.ndarray) -> None:
        n, total = self.count + len(sizes), self.used + len(body)
        if total > len(self.body):
            self.body = np.concatenate([self.body[:self.used], np.empty(len(body) + self.used // 2, self.kind)])
        if n > len(self.first):
            room = len(sizes) + self.count // 2
            self.first = np.concatenate([self.first[:self.count], np.empty(room, np.int64)])
            self.size = np.concatenate([self.size[:self.count], np.empty(room, np.int32)])
        self.body[self.used:total] = body
        self.first[self.count:n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.count:n] = sizes
        self.count, self.used = n, total

    def cut(self, count: int) -> None:
        """Forget what came after the first ``count`` slots."""
        if count < self.count:
            self.count, self.used = count, int(self.first[count])

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(arrays of these slots in a row, their sizes)"""
        sizes = self.size[slots].astype(np.int64)
        after = np.cumsum(sizes)
        total = int(after[-1]) if len(after) else 0
        return self.body[np.arange(total) + np.repeat(self.first[slots] - (after - sizes), sizes)], sizes


class Kept:
    """What a worker knows of distinct pieces of text: ``runs``, whose arrays all have a run for each slot.

    ``fill`` gets the bytes of new pieces and appends to every run, in their order.  Pieces of more than ``SHORT`` bytes
    get slots that hold until the next call only; past ``kept`` (``KEPT``) pieces everything is forgotten before the next one.
    """

    def __init__(self, *runs: Runs, kept: int | None = None):
        self.slots, self.runs, self.limit = Slots(), runs, kept

    def lookup(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, fill) -> np.ndarray:
        """The slot of each span of ``body``."""
        if self.slots.used > (self.limit or KEPT):
            self.slots.clear()
            for run in self.runs:
                run.clear()
        for run in self.runs:
            run.cut(self.slots.used)
        hashes = span_hashes(body, starts, ends)
        found = self.slots.find(hashes)
        long_ = np.flatnonzero(ends - starts > SHORT)
        found[long_] = 0
        new = np.flatnonzero(found < 0)
        names, first, inverse = np.unique(hashes[new], return_index=True, return_inverse=True)
        found[new] = self.slots.used + inverse
        self.slots.add(names)
        found[long_] = self.slots.used + np.arange(len(long_))
        fresh = np.concatenate([new[first], long_])
        if len(fresh):
            raw = body.tobytes()
            fill([raw[a:b] for a, b in zip(starts[fresh].tolist(), ends[fresh].tolist())])
        return found
