"""Texts of an Arrow batch as flat NumPy arrays: bytes, words and word hashes, without a loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 2 << 20

# [\x20\x09-\x0D] ends a word
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# [\x00-\x2F\x3A-\x60\x7B-\x7F] ends a word: only digits, lower-case letters and non-ASCII bytes stay
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text; one row is never cut."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, "right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Return freed arrays to the system; a worker process serves many tasks, and the allocator would keep them."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of each text); a null text is empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return body, offsets - offsets[0]


def word_spans(body: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of each word in ``body`` and the words before each text (one more entry than texts)."""
    n = len(body)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[body]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    values = _BYTE[body[within + np.repeat(starts, sizes)]] * powers(int(sizes.max()))[within]
    return mixed(np.add.reduceat(values, first) + sizes.astype(np.uint64))


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, text by text, with bounds; a shorter text is one run of all its words."""
    counts = np.diff(bounds)
    made = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    if not out_bounds[-1]:
        return np.zeros(0, np.uint64), out_bounds
    weights = mixed(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    first = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], made) + np.repeat(bounds[:-1], made)
    short = np.repeat(np.where(counts < k, counts, k), made)
    total = np.zeros(len(first), np.uint64)
    for j in range(k):
        total += np.where(j < short, padded[first + j] * weights[j], np.uint64(0))
    return mixed(total + short.astype(np.uint64)), out_bounds


def word_set(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of each text, with bounds."""
    runs, edges = shingles(hashes, bounds, k)
    runs = runs.copy()
    for a, b in zip(edges[:-1], edges[1:]):
        runs[a:b].sort()
    keep = np.ones(len(runs), bool)
    if len(runs):
        keep[1:] = runs[1:] != runs[:-1]
        keep[edges[:-1][np.diff(edges) > 0]] = True
    return runs[keep], np.concatenate([[0], np.cumsum(keep)])[edges]


def text_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles (words between white space, A-Z in lower case) of each text."""
    body, offsets = flat(texts)
    body = LOWER[body]
    starts, ends, bounds = word_spans(body, offsets, SPACE)
    return word_set(word_hashes(body, starts, ends), bounds, k)
